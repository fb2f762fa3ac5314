"""The composed weighted machine against the three rules applied one after the other; stems learned in rounds."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa

from quayside.llm import toxicity_wfst as tox
from quayside.llm.spans import text_buffer

WORDS = {"i": "idiot", "t": "kill", "y": "you", "n": "not", "r": "said", "o": "thing", "z": "zorkish"}


def by_rules(clauses):
    """{pattern: (count, weighted sum)} of clauses of symbols, rule by rule over the whole clause."""
    counts, sums = Counter(), Counter()

    def add(pattern, lexical, path):
        counts[pattern] += lexical
        sums[pattern] += lexical * path

    for clause in clauses:
        lexical = [0.5 if s == "z" else 1.0 for s in clause]
        kinds, path = ["i" if s == "z" else s for s in clause], [1.0] * len(clause)
        for k, s in enumerate(list(kinds)):
            if s in "it" and "n" in kinds[max(0, k - tox.NEGATION_REACH) : k]:
                path[k] = 0.25
        negated = [p == 0.25 for p in path]
        reported = [s in "it" and not negated[k] and "r" in kinds[:k] for k, s in enumerate(kinds)]
        waiting, met = None, False
        for k, s in enumerate(kinds):
            if s == "y":
                if waiting is not None:
                    add("J" if kinds[waiting] == "i" else "U", lexical[waiting], 0.5 if kinds[waiting] == "i" else 1.0)
                waiting, met = None, True
            elif s in "it":
                if negated[k]:
                    add("a" if s == "i" else "b", lexical[k], 0.25)
                elif reported[k]:
                    add("c" if s == "i" else "d", lexical[k], 0.5)
                elif met:
                    add("I" if s == "i" else "T", lexical[k], 1.5 if s == "i" else 2.0)
                else:
                    add(s, lexical[k], 1.0)
                    waiting = k
    return counts, sums


def test_composed_machine_by_rules():
    rnd = random.Random(8)
    machine = tox.Machine({b"zork": 0.5})
    texts, wanted = [], []
    for _ in range(400):
        clauses = [[rnd.choice("itynrooz") for _ in range(rnd.randint(0, 9))] for _ in range(rnd.randint(0, 4))]
        texts.append(". ".join(" ".join(WORDS[s] for s in c) for c in clauses))
        wanted.append(by_rules(clauses))
    counts, sums = machine.run(*text_buffer(pa.array(texts, pa.string())))
    for k, (count, total) in enumerate(wanted):
        assert dict(zip(tox.PATTERNS, counts[k])) == {p: count[p] for p in tox.PATTERNS}, texts[k]
        assert np.allclose(sums[k][:-1], [total[p] for p in tox.PATTERNS]), texts[k]


def test_composition_multiplies_weights():
    one = tox.Transducer({(0, "i"): (0, "x", 0.5)})
    two = tox.Transducer({(0, "x"): (1, "y", 0.25)})
    assert one.compose(two).step(0, "i")[1:] == ("y", 0.125)
    assert one.compose(two).step(0, "o") == (0, "o", 1.0)


def test_what_a_path_weighs_shows_in_the_score():
    model = tox.Model({}, (*(tox.PRIOR[p] for p in tox.PATTERNS), tox.RATE), tox.BIAS)
    texts = ["plain words", "you are not an idiot", "he said what an idiot", "what an idiot", "you are an idiot"]
    chance = model.chances(model.machine().run(*text_buffer(pa.array([t + " in some words" * 30 for t in texts])))[1])
    assert list(np.argsort(chance, kind="stable")) == [0, 1, 2, 3, 4] and len(set(chance)) == 5


def test_stems_are_learned_in_rounds():
    rnd = random.Random(3)
    filler = [f"w{rnd.getrandbits(60):x}".encode() for _ in range(4000)]

    def doc(words):
        return [*rnd.sample(filler, 40), *words]

    # "grobzu..." is only in toxic documents; other "grob..." words are in a few clean ones, too.
    toxic = [doc([b"grobzu" + bytes([97 + k % 20]) * 2]) for k in range(40)] + [doc([b"grob" + bytes([97 + k]) * 3]) for k in range(20)]
    clean = [doc([b"grobqq"]) for _ in range(4)] + [doc([]) for _ in range(200)]
    asked = []

    def clean_counts(candidates, stems):
        asked.append(stems)
        held = Counter()
        for words in clean:
            held.update(tox._prefixes(tox._uncovered(words, stems)) & candidates)
        return held

    stems = tox.learn_stems(toxic, clean_counts, len(clean))
    machine = tox.Machine(stems)
    assert all(machine.classify(w[-1])[0] == ord("i") for w in toxic)
    assert machine.classify(filler[0]) == (ord("o"), 0.0)
    assert asked[0] == set() and len(asked) >= 2 and asked[-1] == set(stems)
    assert tox.learn_stems([], clean_counts, 0) == {}
