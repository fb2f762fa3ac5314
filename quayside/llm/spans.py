"""Arrow/numpy helpers shared by the text operators (used inside Spark tasks).

Texts are handled as one byte buffer plus offsets, so that word cuts, hashes and
counts are array operations; Python objects exist only for distinct spans.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string/binary array; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut incoming batches so that each holds about ``limit`` text bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(text)))
        a = 0
        while a < n:
            b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
            b = min(n, max(a + 1, b))
            yield batch.slice(a, b - a)
            a = b


def span_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The spans [starts[i], starts[i+1]) of a buffer as an Arrow binary array (no copy)."""
    offsets = np.append(starts, len(data)).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    )


def gather(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Concatenate flat[starts[i] : starts[i] + lens[i]] for all i."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    if total == 0:
        return flat[:0]
    return flat[np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lens), lens)]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i] : offsets[i+1]] for all i, empty segments included."""
    c = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=c[1:])
    return c[offsets[1:]] - c[offsets[:-1]]


class SpanMemo:
    """Encodes byte spans through ``encode(list of spans) -> (all ids, ids per span)``, each distinct
    span once while the memo lasts. The memo is emptied beyond ``limit`` spans; results never depend on it."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], limit: int = 600_000):
        self.encode, self.limit = encode, limit
        self._reset()

    def _reset(self) -> None:
        self.at: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int64)

    @staticmethod
    def _grown(a: np.ndarray, need: int) -> np.ndarray:
        if need <= len(a):
            return a
        b = np.zeros(max(need, 2 * len(a)), a.dtype)
        b[: len(a)] = a
        return b

    def ids(self, spans: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, ids per span) of an Arrow binary array of spans."""
        if len(spans) == 0:
            return self.flat[:0], np.zeros(0, np.int64)
        coded = spans.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.at) + len(distinct) > self.limit:
            self._reset()
        at = self.at
        place = [at.get(s, -1) for s in distinct]
        new = [s for s, k in zip(distinct, place) if k < 0]
        if new:
            out, lens = self.encode(new)
            k, total = len(at), len(out)
            self.flat = self._grown(self.flat, self.used + total)
            self.starts, self.lens = self._grown(self.starts, k + len(new)), self._grown(self.lens, k + len(new))
            self.flat[self.used : self.used + total] = out
            self.starts[k : k + len(new)] = self.used + np.cumsum(lens) - lens
            self.lens[k : k + len(new)] = lens
            self.used += total
            at.update(zip(new, range(k, k + len(new))))
            place = [at[s] for s in distinct]
        seq = np.array(place, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        lens = self.lens[seq]
        return gather(self.flat, self.starts[seq], lens), lens


def doc_offsets(starts: np.ndarray, lens: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets of each document's ids, given span starts, ids per span and byte offsets of documents."""
    c = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=c[1:])
    return c[np.searchsorted(starts, offsets, side="left")]
