"""Substring dedup over words: a count-min prefilter, then an exact grouping of the suspects.

Every window of ``window`` consecutive words whose sequence also starts
anywhere else in the corpus is a repeat; every word that a repeated window
covers is removed.

1. Each task marks its windows by content (the least hash of the word 8-grams
   inside the window, about one mark per 15 words) and adds the marks to a
   count-min sketch; the partition sketches are merged by block (``sketch``).
   A mark's count is never below that of any window that chose it, so the
   merged sketch overestimates window counts. It is broadcast while it has two
   cells a mark; for a larger corpus it grows with the marks, stays sharded,
   and its verdicts go to the documents (``sketch.verdicts``).
2. Windows whose mark is estimated at two or more are grouped exactly by a
   96-bit hash of their words. Windows that repeat within one task's buffer
   are settled there and sent once, so a very frequent passage costs a row per
   buffer. Windows with the same mark meet in the same bucket, but those of a
   mark that a sample shows as hot are spread by their own hash, as many
   different windows may share it. The number of buckets follows the number
   of windows.
3. Spans go back to their documents in one shuffle of the texts.

Defined results: a null or empty text has no words and stays empty; texts of
fewer than ``window`` words lose nothing; rows that repeat (same id or not)
count as separate occurrences, so repeated texts of ``window`` words or more
are removed in every copy; a null id is kept as null; only the id and text
columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import (
    ROLL_A, ROLL_B, U64, anchors, buffers, covered, inside, mix, places, row_groups, runs, slices, word_hashes,
)
from .occurrences import ROUTED, Buffer, exact
from .spans import SPAN, apply_spans, keyed

WINDOW = 35
GRAM = 8
BITS, DEPTH = 27, 2  # merged sketch: 2 rows of 2^27 cells, 32 MB
MARK_BYTES, LOAD = 64, 1 / 2  # bytes a mark, at least; marks a cell up to which the sketch is broadcast (4 GB of text)
BUFFER = 1 << 20  # suspect windows a task holds before it settles and sends them
PER_BUCKET = 1 << 18  # windows of the whole corpus per bucket

OUT = "doc long, null_id boolean, n_words long, n_removed long, n_spans long, kept string"


def _windows(text: pa.Array, window: int, gram: int) -> Iterator[tuple]:
    """Per group of rows, sliced so that a very long text stays bounded: words, valid window starts, their row and
    place in it, each start's mark, and the marks to count (a slice's edge may count one twice, never too few) with
    their rows and places."""
    raw, offsets = buffers(text)
    for lo, hi in row_groups(offsets):
        part = offsets[lo : hi + 1]
        words, first = word_hashes(raw[part[0] : part[-1]], part - part[0])
        for at, end in slices(len(words), window):
            piece = words[at:end]
            start = np.arange(len(piece) - window + 1)
            row, valid = inside(first, at, start, window)
            if not valid.any():
                continue
            i = np.arange(len(piece) - gram + 1)
            grams = ROLL_A.spans(ROLL_A.prefix(piece), i, i + gram)
            least, marked = anchors(grams, valid, window - gram + 1)
            start, row = start[valid], row[valid]
            seat = places(first, at, marked, lo)
            yield piece, start, lo + row, (start + at - first[row]).astype(np.int32), least[valid], grams[marked], seat


def _marks(window: int, gram: int):
    def run(batches):
        for batch in batches:
            for *_, marks, _ in _windows(batch.column("text"), window, gram):
                yield marks

    return run


def _suspects(bitmap, hot, window: int, gram: int, bits: int, buckets: int):
    """Second pass: windows whose mark the sketch estimates at two or more, routed by mark, or by their own hash where the mark is hot."""

    def run(batches):
        held = Buffer(buckets)
        for batch in batches:
            estimate = sketch.judge(batch, bitmap, bits)
            doc = batch.column("doc").to_numpy()
            tag = batch.column("tag").to_numpy()
            null = batch.column("null_id").to_numpy(zero_copy_only=False).astype(np.int8)
            for words, start, row, at, least, marks, seat in _windows(batch.column("text"), window, gram):
                hit = np.flatnonzero(estimate(least, marks, seat))
                if not len(hit):
                    continue
                begin, r = start[hit], row[hit]
                a = ROLL_A.spans(ROLL_A.prefix(words), begin, begin + window)
                b = (ROLL_B.spans(ROLL_B.prefix(words), begin, begin + window) >> U64(32)).astype(np.uint32)
                spread = sketch.repeated(hot.value, least[hit], sketch.HOT_BITS)
                bucket = (np.where(spread, a, mix(least[hit])) % U64(buckets)).astype(np.int64)
                held.add(a, b, doc[r], tag[r], at[hit], null[r], bucket)
                if held.n >= BUFFER and (out := held.flush()) is not None:
                    yield out
        if (out := held.flush()) is not None:
            yield out

    return run


def _remove(window: int):
    """Last pass: the words left, joined by one space, and what was removed."""

    def run(batches):
        for batch in batches:
            out = {k.split()[0]: [] for k in OUT.split(", ")}
            columns = (batch.column(k).to_pylist() for k in ("doc", "null_id", "at", "size"))
            for i, (doc, null, at, size) in enumerate(zip(*columns, strict=True)):
                text = batch.column("text")[i].as_buffer()
                words = text.to_pybytes().split() if text is not None else []
                n, removed, spans = len(words), 0, 0
                if at:
                    gone = covered(np.array(at), np.array(size) + window - 1, n)
                    removed, spans = int(gone.sum()), len(runs(gone)[0])
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                for k, v in zip(out, (doc, null, n, removed, spans, b" ".join(words).decode()), strict=True):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=OUT_ARROW)

    return run


OUT_ARROW = pa.schema([
    ("doc", pa.int64()), ("null_id", pa.bool_()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("n_spans", pa.int64()), ("kept", pa.string()),
])


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    window: int = WINDOW, gram: int = GRAM, bits: int = BITS, depth: int = DEPTH, hot_rate: float = sketch.HOT_RATE,
    load: float = LOAD,
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, n_spans and the kept text."""
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    spark = docs.sparkSession
    rows = keyed(docs, id_col, text_col)
    texts = rows.select("text")
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(1 << 30, max(64, chars // 6 // PER_BUCKET)))
    n_marks = chars // MARK_BYTES
    if n_marks <= load * (1 << bits):
        bitmap, asked = spark.sparkContext.broadcast(sketch.build(texts, _marks(window, gram), bits, depth)), rows
    else:
        bitmap, asked = None, sketch.verdicts(rows, lambda text: _windows(text, window, gram), n_marks)
    hot = spark.sparkContext.broadcast(sketch.hot(texts, _marks(window, gram), hot_rate))
    routed = asked.mapInArrow(_suspects(bitmap, hot, window, gram, bits, buckets), ROUTED)
    spans = routed.groupBy("bucket").applyInArrow(exact, SPAN)
    out = apply_spans(rows, spans, _remove(window), OUT)
    return out.select(
        F.when(~F.col("null_id"), F.col("doc")).alias(id_col), "n_words", "n_removed", "n_spans", "kept"
    )
