"""Quality rules: per-document counts, then cross-document line frequency within a host.

Lines are split at line feeds, normalised (lower case, runs of separators read
as one space, digits as 0, trimmed) and hashed to 64 bits. A line's frequency
is the number of distinct documents of its host that hold it. A line is above
the limit when that exceeds both ``min_docs`` and ``share`` of the host's
documents; lines above the limit are removed, and a document that keeps less
than ``least_left`` of its words is depleted.

Each task hashes its documents once and sends one narrow row per distinct line
and document; counting is a partial aggregation before its shuffle. Only lines
above a limit come back, at most ``(lines per document) / share`` per host, so
the second join is between the line rows and a small table, which Spark
broadcasts when its measured size allows and otherwise splits where a line is
hot. Texts are never shuffled.

Defined results: a null or empty text has no words and fails the base rules; a
null host is a host of its own; a line without a word is never counted; rows
that repeat an id are one document to the line counts when their texts are
equal too, and each keeps its own result row; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ROLL_A, SEPARATORS, U64, buffers, covered, cut, mix, row_groups, text_tag, word_hashes

MIN_DOCS = 20
SHARE = 0.02
LEAST_LEFT = 0.3
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words

STATS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lines array<long>, line_words array<int>"
)
_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[np.frombuffer(b"#*$%&|<>", dtype=np.uint8)] = 1  # fixed values of the contract
_TAIL = (np.arange(256) & 0xC0) == 0x80  # UTF-8 continuation bytes
_SEP = np.zeros(256, dtype=bool)
_SEP[np.frombuffer(SEPARATORS, dtype=np.uint8)] = True
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_POINT = (~_TAIL & ~_SEP).astype(np.int64)


def repeat_words(words: np.ndarray, n: int = 3) -> int:
    """Words that lie in an ``n``-word window found twice or more (the first one too)."""
    if len(words) < n + 1:
        return 0
    start = np.arange(len(words) - n + 1)
    h = ROLL_A.spans(ROLL_A.prefix(words), start, start + n)
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    hit = start[count[back] > 1]
    return int(covered(hit, np.full(len(hit), n), len(words)).sum()) if len(hit) else 0


def _normal(line: bytes) -> bytes:
    return b" ".join(line.lower().split()).translate(_DIGITS)


def _line_hash(lines: list[bytes]) -> list[int]:
    """64-bit hashes of the normalised lines (non-ASCII letters are lower-cased as text)."""
    if not lines:
        return []
    normal = [_normal(x if x.isascii() else x.decode().lower().encode()) for x in lines]
    # lines are hashed as sequences of words: word hashes of one buffer, then one span per line
    column = pa.array(normal, pa.binary())
    raw, offsets = buffers(column)
    words, first = word_hashes(raw, offsets)
    prefix = ROLL_A.prefix(words)
    return mix(ROLL_A.spans(prefix, first[:-1], first[1:]) ^ U64(0x5851F42D4C957F2D)).view(np.int64).tolist()


def _stats(batches):
    names = [x.strip().split(" ")[0] for x in re.split(r", (?=\w+ )", STATS)]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.list_(pa.int32())]
    for batch in batches:
        text = batch.column("text")
        raw, offsets = buffers(text)
        out = {k: [] for k in names}
        for lo, hi in row_groups(offsets):
            part = offsets[lo : hi + 1] - offsets[lo]
            body = raw[offsets[lo] : offsets[hi]]
            words, first = word_hashes(body, part)
            total = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[body])])[part])
            points, symbols = total(_POINT), total(_SYMBOL)
            for i in range(hi - lo):
                mine = words[first[i] : first[i + 1]]
                split = body[part[i] : part[i + 1]].tobytes().split(b"\n")
                counts = [(x, len(x.split())) for x in split]
                held = [(x, n) for x, n in counts if n]
                lines: dict[int, int] = {}  # words of a normalised line, all its occurrences in this document
                for key, (_, n) in zip(_line_hash([x for x, _ in held]), held, strict=True):
                    lines[key] = lines.get(key, 0) + n
                row = (len(mine), int(points[i]), int(symbols[i]), len(held) - len({x for x, _ in held}),
                       repeat_words(mine), list(lines), list(lines.values()))
                for k, v in zip(names, row, strict=True):
                    out[k].append(v)
        columns = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n != "text"]
        stats = [pa.array(out[k], t) for k, t in zip(names, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([*columns, *stats], names=[n for n in batch.schema.names if n != "text"] + names)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, host, the base counts, and the distinct lines (hash, words) of its text."""
    host = F.col(host_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("doc"), F.col(id_col).isNull().alias("null_id"),
        text_tag(F.col(text_col).cast("string")).alias("tag"),
        F.when(host.isNull(), F.lit(0)).otherwise(F.xxhash64(host)).cast("long").alias("host"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(_stats, f"doc long, null_id boolean, tag long, host long, {STATS}")


def line_quality(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE, least_left: float = LEAST_LEFT,
    min_words: int = MIN_WORDS, max_repeated: int = MAX_REPEATED,
) -> DataFrame:
    """One row per input row: the counts, base_failed, n_removed_words, depleted and kept."""
    stats = cut(measure(docs, id_col, text_col, host_col), "line-stats")
    key = ["doc", "null_id", "tag", "host"]
    # one document per key: rows that repeat id and text count once
    lines = stats.select(*key, F.explode(F.arrays_zip("lines", "line_words")).alias("x"))
    lines = lines.select(*key, F.col("x.lines").alias("line"), F.col("x.line_words").alias("words")).distinct()
    hosts = stats.select(*key).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("docs"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("held"))
    above = counts.filter(F.col("held") > min_docs).join(hosts, "host")
    # stored first: the join broadcasts it where its measured size allows, and else is a stage of its own, whose hot
    # lines adaptive execution can split
    above = cut(above.filter(F.col("held") > F.col("docs") * share).select("host", "line"), "lines-above")
    removed = lines.join(above, ["host", "line"]).groupBy(*key).agg(F.sum("words").alias("removed"))
    out = stats.drop("lines", "line_words").join(removed, key, "left")
    n, gone = F.col("n_words"), F.coalesce(F.col("removed"), F.lit(0))
    failed = (n < min_words) | (F.lit(100) * F.col("n_repeat_words") > F.lit(max_repeated) * n)
    depleted = (n - gone) < F.lit(least_left) * n
    return out.select(
        F.when(~F.col("null_id"), F.col("doc")).alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", failed.alias("base_failed"), gone.alias("n_removed_words"), depleted.alias("depleted"),
        (~failed & ~depleted).alias("kept"),
    )
