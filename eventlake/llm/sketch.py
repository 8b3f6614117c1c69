"""Count-min sketch over content marks: partition sketches, merged by block, kept as one bitmap.

Each task adds its marks to ``DEPTH`` rows of ``2**bits`` counters that
saturate at two, and sends only the non-zero cells, grouped into blocks of
65,536. A shuffle by block adds the partition sketches up. What the second
pass needs is one bit per cell (count of two or more), so the merged sketch
has a fixed size of ``DEPTH * 2**bits / 8`` bytes whatever the corpus holds.
A fuller sketch overestimates more marks; it never underestimates one.

Where a corpus has too many marks for a sketch of that size, ``verdicts``
gives it one row of some 16 cells a mark, sharded and sparse: every task sends
the cells of its marks with their places, a shard adds them up, and the places
counted twice go back to their documents. Nothing grows on the driver or in a
broadcast, and the share of marks overestimated stays the same at any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix
from .occurrences import ROUTED, Buffer, exact
from .spans import SPAN, with_spans

CELLS = 16  # cells a mark in a sharded sketch
PER_SHARD = 1 << 18  # marks of the corpus per shard
BUFFER = 1 << 20  # marks a task holds before it settles and sends their cells
BLOCK_BITS = 16
FLUSH = 1 << 21  # marks a task holds before it sends a partial sketch
HOT_RATE, HOT_BITS = 1 / 8192, 24  # a mark is hot from some 30,000 texts on; 2 MB
PARTIAL = "block long, ones binary, more binary"
MERGED = "block long, bits binary"


def _cells(marks: np.ndarray, row: int, bits: int) -> np.ndarray:
    mask = U64((1 << bits) - 1)
    return (marks & mask) if row == 0 else ((marks >> U64(32)) & mask)


def partial(marks: np.ndarray, bits: int, depth: int) -> pa.RecordBatch:
    """Partial sketch of some marks: per block, the cells counted once and those counted more."""
    blocks, ones, more = [], [], []
    for row in range(depth):
        cells, counts = np.unique(_cells(marks, row, bits), return_counts=True)
        block = (cells >> U64(BLOCK_BITS)).astype(np.int64)
        low = (cells & U64((1 << BLOCK_BITS) - 1)).astype("<u2")
        edges = np.flatnonzero(np.diff(block, prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(block)), strict=True):
            part, once = low[lo:hi], counts[lo:hi] == 1
            blocks.append((row << 32) + int(block[lo]))
            ones.append(part[once].tobytes())
            more.append(part[~once].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array(ones, pa.binary()), pa.array(more, pa.binary())],
        names=["block", "ones", "more"],
    )


def partials(batches: Iterator[np.ndarray], bits: int, depth: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for marks in batches:
        held.append(marks)
        n += len(marks)
        if n >= FLUSH:
            yield partial(np.concatenate(held), bits, depth)
            held, n = [], 0
    if n:
        yield partial(np.concatenate(held), bits, depth)


def _merge(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Add up the partial sketches of this task's blocks; a block takes 16 KB here, however many parts it has."""
    size = 1 << BLOCK_BITS
    seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # one bit per cell each: at least 1, at least 2
    for batch in batches:
        for block, ones, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if block not in seen:
                seen[block] = (np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8))
            some, twice = seen[block]
            part = np.zeros(size, np.uint8)
            part[np.frombuffer(ones, "<u2")] = 1
            once = np.packbits(part, bitorder="little")
            part[:] = 0
            part[np.frombuffer(more, "<u2")] = 1
            many = np.packbits(part, bitorder="little")
            twice |= many | (some & once)
            some |= once | many
    for block, bits in seen.items():
        if bits[least - 1].any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([bits[least - 1].tobytes()], pa.binary())],
                names=["block", "bits"],
            )


def build(docs: DataFrame, marks: Callable, bits: int, depth: int, least: int = 2) -> np.ndarray:
    """The merged bitmap (depth x 2**bits / 8 bytes): cells counted ``least`` (1 or 2) times, of the marks
    that ``marks(batches)`` yields."""
    spread = docs.mapInArrow(lambda it: partials(marks(it), bits, depth), PARTIAL)
    merged = spread.repartition("block").mapInArrow(lambda it: _merge(it, least), MERGED)
    bitmap = np.zeros((depth, (1 << bits) // 8), dtype=np.uint8)
    step = (1 << BLOCK_BITS) // 8
    for row in merged.collect():  # of fixed size, see above
        at = (row.block & 0xFFFFFFFF) * step
        bitmap[row.block >> 32, at : at + step] = np.frombuffer(row.bits, np.uint8)
    return bitmap


def hot(texts: DataFrame, marks: Callable, rate: float = HOT_RATE) -> np.ndarray:
    """Bitmap of the marks seen twice in a sample of the texts. It only says how windows are routed, never which count."""
    return build(texts.where(F.rand(7) < rate), marks, HOT_BITS, 1)


def repeated(bitmap: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    """Which marks lie in set cells only: those the sketch estimates at ``least`` or more."""
    keep = np.ones(len(marks), dtype=bool)
    for row in range(bitmap.shape[0]):
        cell = _cells(marks, row, bits)
        keep &= (bitmap[row, (cell >> U64(3)).astype(np.int64)] >> (cell & U64(7)).astype(np.uint8)) & 1 == 1
    return keep


def _cells_asked(windows: Callable, bits: int, shards: int):
    """The cells of a task's marks, each with its document and place, routed by shard; counted twice in a buffer: settled."""

    def run(batches):
        held = Buffer(shards)
        for batch in batches:
            doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            null = batch.column("null_id").to_numpy(zero_copy_only=False).astype(np.int8)
            for *_, marks, seat in windows(batch.column("text")):
                cell, row = _cells(marks, 0, bits), seat >> 32
                at = (seat & 0xFFFFFFFF).astype(np.int32)
                shard = (mix(cell) % U64(shards)).astype(np.int64)
                held.add(cell, np.zeros(len(cell), np.uint32), doc[row], tag[row], at, null[row], shard)
                if held.n >= BUFFER and (out := held.flush()) is not None:
                    yield out
        if (out := held.flush()) is not None:
            yield out

    return run


def verdicts(rows: DataFrame, windows: Callable, n_marks: int, bits: int | None = None) -> DataFrame:
    """The rows (``spans.keyed``) that hold a mark estimated at two or more, with the places of those marks as spans."""
    bits = bits or max(8, min(63, int(CELLS * n_marks).bit_length()))
    shards = int(min(1 << 30, max(64, n_marks // PER_SHARD)))
    asked = rows.mapInArrow(_cells_asked(windows, bits, shards), ROUTED)
    return with_spans(rows, asked.groupBy("bucket").applyInArrow(exact, SPAN), "inner")


def judge(batch: pa.RecordBatch, bitmap, bits: int) -> Callable:
    """Says which windows' marks are estimated at two or more, given those marks, and the slice's marks with their places.

    With a broadcast bitmap from its cells; without one from the places that ``verdicts`` sent along with the rows.
    """
    if bitmap is not None:
        return lambda least, marks, seat: repeated(bitmap.value, least, bits)
    at, size = batch.column("at"), batch.column("size")
    row = np.repeat(np.arange(len(at)), [len(x) if x is not None else 0 for x in at.to_pylist()])
    first, size = at.flatten().to_numpy().astype(np.int64), size.flatten().to_numpy().astype(np.int64)
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    seats = np.repeat((row << 32) + first, size) + step
    return lambda least, marks, seat: np.isin(least, marks[np.isin(seat, seats)])
