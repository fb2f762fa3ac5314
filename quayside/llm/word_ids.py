"""Ids of whole texts by a ``tokenizers`` vocabulary file, as the library gives them.

For vocabularies that drop white space and split words from digits and signs
(``word_bpe_49k.json``), a text's ids are the ids of its parts, cut before white space and
between ASCII letters, digits and signs. The library encodes each distinct part once per
worker while the memo lasts. The library lower-cases and takes any white space as a
space, so that is done first, on bytes. Not cut beside ' (contractions) and < | > (special tokens).
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa

from quayside.llm.spans import SpanMemo, doc_offsets, span_array, text_buffer

_SPACE = b"\t\n\v\f\r "
_SIGNS = b'!"#$%&()*+,-./:;=?@[\\]^_`{}~'

#: Words of a-z and the lower-case letters of Latin-1: normalisation and word cuts leave them as they are.
PLAIN = re.compile(rb" ?(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_chars() -> dict[int, int]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()
#: ASCII letters in lower case, white space as a space.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[ord("A") : ord("Z") + 1] += 32
FOLD[list(_SPACE)] = 32


def _cut_table() -> np.ndarray:
    kind = np.zeros(256, np.uint8)  # 0: never cut beside it, but for white space
    kind[ord("A") : ord("Z") + 1] = kind[ord("a") : ord("z") + 1] = 1
    kind[ord("0") : ord("9") + 1] = 2
    kind[list(_SIGNS)] = 3
    space = np.zeros(256, bool)
    space[list(_SPACE)] = True
    cut = (kind[:, None] != kind[None, :]) & (kind[:, None] > 0) & (kind[None, :] > 0)
    cut |= ~space[:, None] & space[None, :]
    return cut.ravel()


class WordIds:
    """Ids per text, without special tokens."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file)
        self.cut = _cut_table()
        self.memo = SpanMemo(self._encode)

    def _encode(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Plain lower-case words go to the library's model, which is all that acts on them; others through the whole library."""
        out, rest, model = [None] * len(spans), [], self.library.model
        for k, s in enumerate(spans):
            if PLAIN.fullmatch(s):
                out[k] = [t.id for t in model.tokenize(s.lstrip().decode("latin-1").translate(BYTE_CHARS))]
            else:
                rest.append(k)
        texts = [spans[k].decode() for k in rest]
        for k, e in zip(rest, self.library.encode_batch_fast(texts, add_special_tokens=False)):
            out[k] = e.ids
        lens = np.fromiter(map(len, out), np.int64, len(out))
        return np.fromiter(chain.from_iterable(out), np.int32, int(lens.sum())), lens

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text); null counts as empty."""
        data, offsets = text_buffer(texts)
        if not ((data[:-1] == ord("<")) & (data[1:] == ord("|"))).any():  # special tokens are told by case
            data = FOLD[data]
        begin = np.zeros(len(data), bool)
        begin[1:] = self.cut[data[:-1].astype(np.uint16) << 8 | data[1:]]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        ids, lens = self.memo.ids(span_array(data, starts))
        return ids, doc_offsets(starts, lens, offsets)

    def encode_ended(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text) with ``end_id`` after each text."""
        ids, off = self.encode_batch(texts)
        at = off + np.arange(len(off))
        full = np.empty(len(ids) + len(texts), "<u4")
        ends = np.zeros(len(full), bool)
        ends[at[1:] - 1] = True
        full[ends], full[~ends] = end_id, ids
        return full, at


@lru_cache(maxsize=2)
def word_ids(tokenizer_file: str) -> WordIds:
    """One encoder per Python worker and vocabulary file."""
    return WordIds(tokenizer_file)
