"""Shared pieces of the training-data operators: lineage cuts and vectorised text hashing.

The hashing helpers work on an Arrow string column's own buffer: one contiguous
byte array plus row offsets. They never look past one piece of ``PIECE`` bytes
at a time, so a very long text costs memory per word, not per byte.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

# Fixed value: word separators of the contracts, [\x20\x09-\x0D].
SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
PIECE = 1 << 20

U64 = np.uint64


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with a table that outlives any executor; the folder is the
    cluster's scratch space (``spark.checkpoint.dir``) and is cleaned with it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_tag(text) -> F.Column:
    """CRC-32 of the text: tells rows apart that repeat a doc_id with another text."""
    return F.coalesce(F.crc32(text), F.lit(0)).cast("long")


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit avalanche (the public splitmix64 finaliser)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


class Rolling:
    """Hash of any sub-sequence of a uint64 array from one prefix sum (mod 2^64).

    ``sum(x[i] * base^i)`` over the span, shifted back to the span's start, so
    equal sequences hash alike wherever they stand.
    """

    def __init__(self, base: int):
        self.base, self.inv = base, pow(base, -1, 1 << 64)
        self.pow = self.ipow = np.empty(0, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.pow) < n:
            m = 1 << max(16, int(n - 1).bit_length())
            self.pow, self.ipow = _powers(self.base, m), _powers(self.inv, m)

    def prefix(self, x: np.ndarray) -> np.ndarray:
        self._grow(len(x) + 1)
        out = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x * self.pow[: len(x)], out=out[1:], dtype=np.uint64)
        return out

    def spans(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((prefix[end] - prefix[start]) * self.ipow[start])


ROLL_A = Rolling(0x9E3779B97F4A7C15)
ROLL_B = Rolling(0xD1342543DE82EF95)
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x2545F4914F6CDD1D))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[np.frombuffer(SEPARATORS, dtype=np.uint8)] = False


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of an Arrow string or binary array; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        kind = np.int32
    if column.null_count:
        empty = "" if "string" in str(column.type) else b""
        column = column.fill_null(pa.scalar(empty, column.type))
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``PIECE`` bytes that end at a row's end or after a separator."""
    lo, n = 0, len(raw)
    while lo < n:
        hi = min(n, lo + PIECE)
        if hi < n:
            row_end = int(offsets[np.searchsorted(offsets, hi, side="right") - 1])
            if row_end > lo:
                hi = row_end
            else:
                while hi < n and _IS_WORD[raw[hi - 1]]:
                    step = np.flatnonzero(~_IS_WORD[raw[hi : hi + PIECE]])
                    hi = hi + int(step[0]) + 1 if len(step) else min(n, hi + PIECE)
                hi = min(hi, int(offsets[np.searchsorted(offsets, lo, side="right")]))
        yield lo, hi
        lo = hi


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per piece: its byte range and the starts and ends of its words, relative to the piece."""
    for lo, hi in pieces(raw, offsets):
        word = _IS_WORD[raw[lo:hi]]
        edge = np.ones(hi - lo + 1, dtype=bool)
        edge[1:-1] = ~word[:-1]
        inner = offsets[(offsets > lo) & (offsets < hi)] - lo
        edge[inner] = True
        starts = np.flatnonzero(word & edge[:-1])
        after = np.ones(hi - lo, dtype=bool)
        after[:-1] = ~word[1:]
        after[inner - 1] = True
        yield lo, hi, starts, np.flatnonzero(word & after) + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the index of each row's first word (n + 1 entries)."""
    hashes, places = [], []
    for lo, hi, starts, ends in word_spans(raw, offsets):
        prefix = ROLL_A.prefix(_BYTES[raw[lo:hi]])
        hashes.append(ROLL_A.spans(prefix, starts, ends) + (ends - starts).astype(np.uint64))
        places.append(starts + lo)
    if not hashes:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(place, offsets).astype(np.int64)


def row_groups(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Consecutive rows whose bytes add up to about ``size`` (a longer row stands alone)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every ``width`` neighbours: len(x) - width + 1 values."""
    if len(x) < width:
        return x[:0]
    have, out = 1, x
    while have * 2 <= width:
        out = op(out[: len(out) - have], out[have:])
        have *= 2
    if have < width:
        gap = width - have
        out = op(out[: len(out) - gap], out[gap:])
    return out


def anchors(grams: np.ndarray, valid: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Content-chosen marks: the smallest gram hash among the ``width`` grams of each window.

    ``valid`` says which window starts lie inside one row. Returns the mark of
    every window and which grams are a mark of some window. Equal windows
    choose equal marks at equal places, so a mark's count is never below the
    count of any window that chose it.
    """
    least = slide(grams, width, np.minimum)
    held = np.where(valid, least, U64(0))
    pad = np.zeros(width - 1, dtype=np.uint64)
    most = slide(np.concatenate([pad, held, pad]), width, np.maximum)
    return least, most == grams


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.diff(np.concatenate([[0], flags.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in some span [start, start + length)."""
    step = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + lengths, n), minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def slices(n: int, window: int, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of ``size`` window starts, each with the ``window - 1`` items that its last windows reach into."""
    for lo in range(0, max(0, n - window + 1), size):
        yield lo, min(n, lo + size + window - 1)


def inside(first: np.ndarray, lo: int, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each window start (counted from ``lo``) and whether the window ends within that row."""
    row = np.searchsorted(first, starts + lo, side="right") - 1
    return row, first[row + 1] - lo - starts >= window


def places(first: np.ndarray, lo: int, marked: np.ndarray, row: int) -> np.ndarray:
    """Row (from ``row`` on) and place in it, as one number, of the marked items of a slice that starts at ``lo``."""
    i = np.flatnonzero(marked) + lo
    r = np.searchsorted(first, i, side="right") - 1
    return ((row + r) << 32) + (i - first[r])
