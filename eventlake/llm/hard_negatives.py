"""Hard-negative mining with exact integer scores from a residue-number-system matrix product.

Scores are inner products of whole-number vectors. They are computed in
float32, which holds whole numbers below 2^24 only: the vectors are reduced
modulo several small odd primes to the symmetric residues -(p-1)/2 .. (p-1)/2,
each pair of residue matrices is multiplied in float32 (exact, as ``CHUNK``
products of such residues stay below 2^24), and the products are put together
by Chinese remaindering in mixed radix with symmetric digits, which gives the
signed score itself. As many primes are taken as the largest possible score of
the tables needs.

The anchors are the stated query set against all rows. Their pairs are formed
in cells, an anchor group by a stripe of rows: rows are copied once per anchor
group (of ``GROUP`` anchors), anchors once per stripe, and a cell is streamed
through one task that holds the group's vectors and its best entries, nothing
that grows with the rows. A first product finds every anchor's positives, a
second one, with the score windows that these set, its negatives; each cell
sends on at most the wanted number of entries per anchor and window, and a
ranked selection over the cells keeps the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

CHUNK = 256  # components multiplied before a reduction
GROUP = 16384  # anchors that one task holds
ANCHORS_AT_ONCE, ROWS_AT_ONCE = 512, 2048  # of one block of scores
LARGEST = 509  # of the primes: 256 * 254^2 < 2^24

_NONE = np.iinfo(np.int64).min


def primes_for(limit: int) -> list[int]:
    """Odd primes, falling from ``LARGEST``, whose product exceeds ``2 * limit``."""
    out, product, p = [], 1, LARGEST
    while product <= 2 * limit:
        if all(p % d for d in range(3, math.isqrt(p) + 1, 2)):
            out.append(p)
            product *= p
        p -= 2
        if p < 3:
            raise ValueError(f"scores of up to {limit} need more primes than there are up to {LARGEST}")
    return out


def _symmetric(x: np.ndarray, p: int) -> np.ndarray:
    """Residues in -(p-1)/2 .. (p-1)/2 of whole float64 numbers."""
    r = np.fmod(x, p)
    return r - p * np.rint(r / p)


def residues(vectors: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [_symmetric(vectors, p).astype(np.float32) for p in primes]


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products (int64) of all rows of two sets of vectors given by their residues."""
    digits: list[np.ndarray] = []
    score: np.ndarray | None = None
    weight = 1
    for k, p in enumerate(primes):
        a, b = left[k], right[k]
        rest = 0.0
        for lo in range(0, a.shape[1], CHUNK):
            rest = _symmetric(rest + (a[:, lo : lo + CHUNK] @ b[:, lo : lo + CHUNK].T).astype(np.float64), p)
        if isinstance(rest, float):  # vectors without components
            rest = np.zeros((len(a), len(b)))
        for q, digit in zip(primes, digits):
            rest = _symmetric((rest - digit) * pow(q, -1, p), p)
        digits.append(rest)
        part = rest.astype(np.int64) * np.int64(weight)
        score = part if score is None else score + part
        weight *= p
    return score


class _Best:
    """The ``k`` best (score, id) of every lane: higher scores first, then smaller ids."""

    def __init__(self, lanes: int, k: int):
        self.score = np.full((lanes, k), _NONE, dtype=np.int64)
        self.id = np.zeros((lanes, k), dtype=np.int64)
        self.count = np.zeros(lanes, dtype=np.int64)
        self.k = k

    def bar(self, lanes) -> np.ndarray:
        """The score that an entry of each lane must reach."""
        return self.score[lanes, -1]

    def add(self, lane: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(lane)
        held, slot = np.nonzero(np.arange(self.k) < self.count[touched][:, None])
        lane = np.concatenate([touched[held], lane])
        score = np.concatenate([self.score[touched[held], slot], score])
        ids = np.concatenate([self.id[touched[held], slot], ids])
        order = np.lexsort((ids, ~score, lane))
        lane, score, ids = lane[order], score[order], ids[order]
        place = np.arange(len(lane)) - np.searchsorted(lane, lane)
        keep = place < self.k
        lane, place = lane[keep], place[keep]
        self.score[lane, place], self.id[lane, place] = score[keep], ids[keep]
        self.count[touched] = np.bincount(np.searchsorted(touched, lane), minlength=len(touched))

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lane, place = np.nonzero(np.arange(self.k) < self.count[:, None])
        return lane, self.score[lane, place], self.id[lane, place]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as float64 rows; a shorter one ends in zeros."""
    ends = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(ends)
    if (sizes == width).all():
        return flat[ends[0] : ends[-1]].reshape(len(column), width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = flat[ends[0] : ends[-1]]
    return out


def _scan(wanted: int, width: int, primes: list[int], same: bool):
    """The task over cells: best rows of the anchors' own label (``same``) or of others, within each score window."""

    def finish(cell) -> pa.RecordBatch:
        keys, n_windows, best = cell["key"], cell["windows"], cell["best"]
        lane, score, ids = best.entries()
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[lane // n_windows]), pa.array((lane % n_windows).astype(np.int32)), pa.array(ids), pa.array(score)],
            names=["key", "lane", "id", "score"],
        )

    def begin(parts: list[pa.RecordBatch]) -> dict:
        a = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        low, high = (np.array(a.column(c).to_pylist(), dtype=np.int64).reshape(a.num_rows, -1) for c in ("low", "high"))
        return {
            "key": a.column("key").to_numpy(), "id": a.column("id").to_numpy(), "label": a.column("label").to_numpy(),
            "vectors": residues(_matrix(a.column("vector"), width), primes), "low": low, "high": high,
            "windows": low.shape[1], "best": _Best(low.size, wanted),
        }

    def score_rows(cell: dict, rows: pa.RecordBatch) -> None:
        ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        vectors = residues(_matrix(rows.column("vector"), width), primes)
        best, windows = cell["best"], cell["windows"]
        for lo in range(0, len(cell["id"]), ANCHORS_AT_ONCE):
            some = slice(lo, lo + ANCHORS_AT_ONCE)
            score = products([m[some] for m in cell["vectors"]], vectors, primes)
            fits = (cell["label"][some][:, None] == labels) == same
            fits &= cell["id"][some][:, None] != ids
            for w in range(windows):
                lanes = np.arange(lo, lo + len(score)) * windows + w
                bar = np.maximum(cell["low"][some, w], best.bar(lanes))
                a, r = np.nonzero(fits & (score >= bar[:, None]) & (score <= cell["high"][some, w][:, None]))
                if len(a):
                    best.add(lanes[a], score[a, r], ids[r])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, anchors, cell = None, [], None
        for batch in batches:
            cells, roles = batch.column("cell").to_numpy(), batch.column("role").to_numpy()
            edges = np.flatnonzero(np.diff(cells) | np.diff(roles)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(cells)]):
                if lo == hi:
                    continue
                if cells[lo] != number:
                    if cell:
                        yield finish(cell)
                    number, anchors, cell = cells[lo], [], None
                if roles[lo] == 0:
                    anchors.append(batch.slice(lo, hi - lo))
                    continue
                if anchors and cell is None:
                    cell = begin(anchors)
                for at in range(lo, hi, ROWS_AT_ONCE):
                    if cell:
                        score_rows(cell, batch.slice(at, min(ROWS_AT_ONCE, hi - at)))
        if cell:
            yield finish(cell)

    return work


def _best(rows: DataFrame, anchors: DataFrame, groups: int, stripes: int, wanted: int, width: int, primes: list[int],
          same: bool) -> DataFrame:
    """``(key, lane, id, score, place)``: the ``wanted`` best rows of every anchor and window (``low``/``high``)."""
    nothing = F.lit(None).cast("array<bigint>")
    vector = rows.schema["vector"].dataType
    right = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), "id", "label", "vector",
        F.pmod(F.monotonically_increasing_id(), F.lit(stripes)).alias("stripe"),
    ).select((F.col("group") * stripes + F.col("stripe")).alias("cell"), F.lit(1).alias("role"), F.lit(0).cast("long").alias("key"),
             "id", "label", "vector", nothing.alias("low"), nothing.alias("high"))
    left = anchors.select("key", "id", "label", "vector", "low", "high", F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group"),
                          F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"))
    left = left.select((F.col("group") * stripes + F.col("stripe")).alias("cell"), F.lit(0).alias("role"), "key", "id", "label",
                       F.col("vector").cast(vector).alias("vector"), "low", "high")
    cells = left.unionByName(right).repartitionById(groups * stripes, F.col("cell").cast("int"))
    found = cells.sortWithinPartitions("cell", "role").mapInArrow(
        _scan(wanted, width, primes, same), "key long, lane int, id long, score long")
    by = Window.partitionBy("key", "lane").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(by)).where(F.col("place") <= wanted)


def _smallest(limit: float) -> str:
    """The narrowest type for components up to ``limit``."""
    return "smallint" if limit < 2**15 else "int" if limit < 2**31 else "bigint" if limit < 2**53 else "double"


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 3, high: int = 9,
                   id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """For every anchor and positive the first ``negatives`` rows of another label within a window of its score.

    ``rows`` holds whole-number vectors (array<double>). A row's score is its exact inner product with the anchor;
    higher scores come first, ties by smaller id. An anchor's positives are its first ``positives`` other rows of its
    label; a negative's score lies from ``low`` to ``high`` tenths of its positive's, so a positive score below zero
    has none. Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows without id, label or vector, or with a null or non-finite component, take no part. A vector shorter than the
    longest ends in zeros. Rows that repeat are rows of their own: as candidates they stand next to each other, as
    anchors each has its results; another row is one with another id. Other columns are not read. An empty table, or
    one without anchors, gives no rows. Scores must fit a long: vectors that allow larger ones are an error.
    """
    spark = rows.sparkSession
    x = F.col(vector_col).cast("array<double>")
    usable = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), x.alias("vector"), is_anchor.alias("anchor")
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    usable = usable.where(finite)
    largest = F.aggregate("vector", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v)))
    size = usable.agg(
        F.max(F.size("vector")).alias("width"), F.max(largest).alias("all"), F.max(F.when(F.col("anchor"), largest)).alias("anchors"),
        F.count_if("anchor").alias("n_anchors"),
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size["n_anchors"]:
        return spark.createDataFrame([], schema)
    bound = size["width"] * int(size["all"]) * int(size["anchors"])
    if bound >= 2**63:
        raise ValueError(f"scores of up to {bound} do not fit a long")
    primes, width = primes_for(max(1, bound)), size["width"]
    stripes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = -(-size["n_anchors"] // GROUP)

    packed = usable.withColumn("vector", F.col("vector").cast(f"array<{_smallest(size['all'])}>"))
    stored = cut(packed, "hard-negatives-rows")
    one_window = lambda edge: F.array(F.lit(edge).cast("long"))
    anchors = cut(
        stored.where("anchor").select(F.monotonically_increasing_id().alias("key"), "id", "label", "vector"), "hard-negatives-anchors"
    )
    everything = anchors.withColumns({"low": one_window(_NONE), "high": one_window(-_NONE - 1)})
    near = _best(stored, everything, groups, stripes, positives, width, primes, same=True)
    near = near.select(
        "key", F.col("place").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        # ceil(low * score / 10) and floor(high * score / 10) without leaving a long
        (F.expr(f"(score - pmod(score, 10)) div 10 * {low}") + F.expr(f"({low} * pmod(score, 10) + 9) div 10")).alias("low"),
        (F.expr(f"(score - pmod(score, 10)) div 10 * {high}") + F.expr(f"{high} * pmod(score, 10) div 10")).alias("high"),
    )
    near = cut(near, "hard-negatives-positives")
    # a window that is missing holds nothing
    edge = lambda name, none: F.transform(
        F.sequence(F.lit(1), F.lit(positives)), lambda i: F.coalesce(F.try_element_at(F.col(name), i), F.lit(none).cast("long")))
    windows = near.groupBy("key").agg(
        F.map_from_entries(F.collect_list(F.struct("positive", "low"))).alias("lows"),
        F.map_from_entries(F.collect_list(F.struct("positive", "high"))).alias("highs"),
    ).select("key", edge("lows", 0).alias("low"), edge("highs", -1).alias("high"))
    mined = _best(stored, anchors.join(windows, "key"), groups, stripes, negatives, width, primes, same=False)
    mined = mined.select("key", (F.col("lane") + 1).alias("positive"), F.col("place").alias("rank"),
                         F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select("key", F.col("id").alias("anchor_id"))
    out = mined.join(near, ["key", "positive"]).join(ids, "key")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
