"""SentencePiece encoding and decoding of whole texts for merge-type (BPE) vocabularies.

Method: a score-ordered agenda of adjacent symbol pairs. A text starts as its single
characters; the agenda (a heap) holds every adjacent pair whose concatenation is a
piece, best score first, leftmost first among equals; the top pair is merged, its
new neighbours enter the agenda, and entries whose symbols have changed are skipped.

A merge can only happen where some piece holds the two characters next to each other.
Texts are therefore cut, by one array operation per Arrow batch, wherever the last byte
of a character and the first byte of the next never adjoin inside any piece; the agenda
runs once per distinct span. The agendas of many short spans are held together, as one
array of pair scores: each round pops every span's best pair, leftmost first among
equals, merges it and rescores its two neighbours. Spans of more than LONG_SPAN
characters have a heap of their own. Every new span's ids are compared in the same batch with
the sentencepiece library (behind a line break, which no piece joins to anything, so
that the library's word-start prefix stays apart); a difference raises.

Defined results: null and empty texts have the begin and end id only and decode to "";
rows with equal or null ids are encoded like any other; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quayside.llm.spans import SpanMemo, doc_offsets, slices, span_array, text_buffer
from quayside.session import ship_package

#: The mark that SentencePiece writes for a space.
SPACE_MARK = "▁"
#: A character that no piece joins to another.
GUARD = "\n"
#: Spans of more characters get a heap; the work of a round grows with the span, a heap's does not.
LONG_SPAN = 64
NO_PAIR = np.int64(1) << 62


class AgendaEncoder:
    """Merge-type vocabulary with byte fallback, identity normalisation and a word-start prefix."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        if lib.encode("a  b ﬁ ", out_type=str, emit_unk_piece=False) and lib.decode(lib.encode("a  b ﬁ")) != "a  b ﬁ":
            raise ValueError("only vocabularies with identity normalisation are supported")
        self.bos, self.eos, self.unk = lib.bos_id(), lib.eos_id(), lib.unk_id()
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte = [self.unk] * 256
        joins = np.zeros((256, 256), bool)
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                piece = piece.replace(SPACE_MARK, " ")
                self.rank[piece], self.id[piece] = -lib.get_score(i), i
                raw = piece.encode()
                for a, b in zip(raw, raw[1:]):
                    joins[a, b] = True
        if joins[ord(GUARD)].any() or joins[:, ord(GUARD)].any():
            raise ValueError("the vocabulary must not join line breaks to other characters")
        self.guard_ids = len(lib.encode(GUARD))
        cut = ~joins
        cut[:, 0x80:0xC0] = False  # never inside a character
        self.cut = cut.ravel()
        self._pair_table()
        self.memo = SpanMemo(self._checked)

    def encode_span(self, text: str) -> list[int]:
        """Ids of a text in which spaces stand for the space mark, by the agenda."""
        rank, symbols = self.rank, list(text)
        n = len(symbols)
        if n > 1:
            left, right = list(range(-1, n - 1)), list(range(1, n + 1))
            right[-1] = -1
            agenda = []
            for i in range(n - 1):
                r = rank.get(symbols[i] + symbols[i + 1])
                if r is not None:
                    agenda.append((r, i, i + 1, len(symbols[i]) + len(symbols[i + 1])))
            heapq.heapify(agenda)
            while agenda:
                _, a, b, size = heapq.heappop(agenda)
                x, y = symbols[a], symbols[b]
                if not x or not y or len(x) + len(y) != size:
                    continue
                symbols[a], symbols[b] = x + y, ""
                nxt = right[b]
                right[a] = nxt
                if nxt >= 0:
                    left[nxt] = a
                    r = rank.get(symbols[a] + symbols[nxt])
                    if r is not None:
                        heapq.heappush(agenda, (r, a, nxt, size + len(symbols[nxt])))
                prv = left[a]
                if prv >= 0:
                    r = rank.get(symbols[prv] + symbols[a])
                    if r is not None:
                        heapq.heappush(agenda, (r, prv, a, len(symbols[prv]) + size))
        ids = []
        for s in symbols:
            if s:
                i = self.id.get(s)
                if i is not None:
                    ids.append(i)
                else:
                    ids.extend(self._fallback(s))
        return ids

    def _pair_table(self) -> None:
        """Symbols (pieces, and characters that occur in pieces) by number, and the pairs that make a piece."""
        self.symbol = {p: k for k, p in enumerate(dict.fromkeys([*self.rank, *"".join(self.rank)]))}
        order = {r: k for k, r in enumerate(sorted(set(self.rank.values())))}
        pairs = sorted(
            (self.symbol[p[:i]] << 32 | self.symbol[p[i:]], order[self.rank[p]], self.symbol[p])
            for p in self.rank
            for i in range(1, len(p))
            if p[:i] in self.symbol and p[i:] in self.symbol
        )
        self.pair_key, self.pair_rank, self.pair_makes = (np.array(x, np.int64) for x in zip(*pairs))
        self.symbol_text = list(self.symbol)
        self.symbol_id = np.array([self.id.get(p, -1) for p in self.symbol_text], np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in the pair table; -1 where two symbols make no piece."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((self.pair_key[at] == key) & (left >= 0) & (right >= 0), at, -1)

    def encode_spans(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols, symbols per span) of short spans, by agendas held together; a negative symbol is
        the complement of an unlisted character's code point."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.int32).astype(np.int64)
        chars, inverse = np.unique(points, return_inverse=True)
        sym = np.array([self.symbol.get(chr(c), ~c) for c in chars.tolist()], np.int64)[inverse]
        span = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        done_sym, done_span = [], []

        def agenda(places: np.ndarray) -> np.ndarray:
            """Agenda entry of the pairs that start at these places: score order, then place."""
            nxt = np.minimum(places + 1, len(sym) - 1)
            at = self._pairs(sym[places], sym[nxt])
            ok = (at >= 0) & (nxt > places) & (span[nxt] == span[places])
            return np.where(ok, self.pair_rank[at] << 32 | places, NO_PAIR)

        entry = agenda(np.arange(len(sym)))
        while len(sym):
            first = np.flatnonzero(np.diff(span, prepend=-1))
            best = np.minimum.reduceat(entry, first)
            ended = best == NO_PAIR
            if ended.any():
                out = np.repeat(ended, np.diff(np.append(first, len(sym))))
                done_sym.append(sym[out])
                done_span.append(span[out])
                rest = np.cumsum(~out) - 1  # new places
                sym, span, entry = sym[~out], span[~out], entry[~out]
                best = best[~ended]
                if not len(sym):
                    break
                best = best >> 32 << 32 | rest[best & 0xFFFFFFFF]
            at = best & 0xFFFFFFFF
            sym[at] = self.pair_makes[self._pairs(sym[at], sym[at + 1])]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            sym, span, entry = sym[keep], span[keep], entry[keep]
            entry = np.where(entry == NO_PAIR, NO_PAIR, entry >> 32 << 32 | np.arange(len(sym)))
            at = place[at]
            entry[at] = agenda(at)
            before = at[at > 0] - 1
            entry[before] = agenda(before)
        sym, span = np.concatenate(done_sym or [points[:0]]), np.concatenate(done_span or [points[:0]])
        by_span = np.argsort(span, kind="stable")
        return sym[by_span], np.bincount(span, minlength=len(texts))

    def _ids(self, symbols: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols; characters that are no piece become bytes, or the unknown id."""
        ids = np.where(symbols >= 0, self.symbol_id[np.maximum(symbols, 0)], -1)
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            chars = [self.symbol_text[s] if s >= 0 else chr(~s) for s in symbols[odd].tolist()]
            fall = [self._fallback(c) for c in chars]
            width = np.ones(len(ids), np.int64)
            width[odd] = [len(f) for f in fall]
            of = np.repeat(np.arange(len(lens)), lens)
            ids, was = np.repeat(ids, width), np.repeat(ids < 0, width)
            ids[was] = [i for f in fall for i in f]
            lens = np.bincount(of, weights=width, minlength=len(lens)).astype(np.int64)
        return ids.astype(np.int32), lens

    def _fallback(self, char: str) -> list[int]:
        raw = (SPACE_MARK if char == " " else char).encode()
        return [self.byte[x] for x in raw] if self.byte[0] != self.unk else [self.unk]

    def _checked(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [s.decode() for s in spans]
        short = [t for t in texts if len(t) <= LONG_SPAN]
        ids, lens = self._ids(*self.encode_spans(short))
        if len(short) < len(texts):
            parts, ends, k = np.split(ids, np.cumsum(lens)[:-1]) if short else [], [], 0
            for t in texts:
                if len(t) <= LONG_SPAN:
                    ends.append(parts[k])
                    k += 1
                else:
                    ends.append(np.array(self.encode_span(t), np.int32))
            ids, lens = np.concatenate(ends), np.array([len(x) for x in ends], np.int64)
        library = [x[self.guard_ids :] for x in self.library.encode([GUARD + t for t in texts], num_threads=1)]
        if lens.tolist() != [len(x) for x in library] or ids.tolist() != [i for x in library for i in x]:
            raise ValueError("the agenda's and the library's ids differ")
        return ids, lens

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text) without begin and end ids."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE_MARK, " ")
        filled = pc.binary_length(texts)
        prefixed = pc.if_else(pc.equal(filled, 0), texts, pc.binary_join_element_wise("", texts, " "))
        data, offsets = text_buffer(prefixed)
        begin = np.zeros(len(data), bool)
        begin[1:] = self.cut[data[:-1].astype(np.uint16) << 8 | data[1:]]
        begin[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begin)
        ids, lens = self.memo.ids(span_array(data, starts))
        return ids, doc_offsets(starts, lens, offsets)


@lru_cache(maxsize=2)
def encoder(model_file: str) -> AgendaEncoder:
    """One encoder per Python worker and vocabulary file."""
    return AgendaEncoder(model_file)


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = True) -> DataFrame:
    """Encode whole texts with begin and end ids.

    Returns id_col, n_tokens, ids (binary: little-endian unsigned 32-bit ids) and decoded
    (the library's decode(ids); null if ``decode`` is off), one row per input row.
    """
    ship_package(docs.sparkSession)
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        for batch in slices(batches, "text", 4 << 20):
            ids, off = enc.encode_batch(batch.column(1))
            n = batch.num_rows
            full = np.empty(len(ids) + 2 * n, "<u4")
            at = off + 2 * np.arange(n + 1)  # each text's ids with its begin and end id
            ends = np.zeros(len(full), bool)
            ends[at[:-1]] = True
            ends[at[1:] - 1] = True
            full[~ends] = ids
            full[at[:-1]], full[at[1:] - 1] = enc.bos, enc.eos
            coded = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(4 * at.astype(np.int64)), pa.py_buffer(full)])
            decoded = None
            if decode:
                listed = full.tolist()
                decoded = enc.library.decode([listed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], num_threads=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(at)), coded.cast(pa.binary()), pa.array(decoded or [None] * n, pa.string())],
                ["doc_id", "n_tokens", "ids", "decoded"],
            )

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, schema)


__all__ = ["AgendaEncoder", "encode"]
