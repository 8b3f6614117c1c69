"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Every source gets a share of the total size by its weight, stopped at ``limit``
times its own size; what a stopped source cannot take goes to the others by
weight (``targets``). Within a source every document expects
``target / source_size`` copies. Expected copies are prefix-summed over the
source's documents, one random offset per source is added, and a document is
emitted once for each integer boundary its step crosses: ``floor(rate)`` or
``ceil(rate)`` copies.

Documents are summed in order of size class (the seven leading binary digits),
so errors of neighbours cancel and the taken size lands within about the
largest document of the target. The prefix sum has three levels, and none puts
a source into one task: classes of a source (some 2,500 at most), 4,096 hash
buckets of a class, and the documents of a bucket, which are the only rows the
row-level window sees together. The source table has one row per source and is
ranked in one task.

Defined results: a null text or size counts 0; a null source is a source of
its own, last in order; a source of size 0 has target 0 and takes nothing; an
empty table gives an empty result; identical rows share the copies of their
places in the order; ``copies`` replaces input columns named like an added one; a null
id is hashed as the empty string. Reruns agree: all order comes from the data
and all randomness from MD5 of the seed, the source and the id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import window as WN

from .common import WORD

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix"
CELL = ["__src", "__nul", "__bits", "__top", "__bucket"]
ADDED = ("size", "source_size", "target", "copies")


def word_count(text) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(text: Column) -> Column:
    """A number in [0, 1) with 20 binary digits, from MD5."""
    return F.conv(F.substring(F.md5(text), 1, 5), 16, 10).cast("long") / F.lit(1048576.0)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """Adds ``target`` to one row per source (``__src``, ``__nul``, ``source_size``).

    Sources in order of ``limit * size / weight`` are stopped while that lies
    below the level that shares the rest of the total by weight.
    """
    by_name = WN.Window.orderBy("__nul", "__src")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (turn + 1).cast("int"))
    ranked = sizes.withColumn("__w", w.cast("long")).withColumn("__cap", F.col("source_size") * limit)
    order = WN.Window.orderBy(F.col("__cap") / F.col("__w"), "__nul", "__src")
    before = order.rowsBetween(WN.Window.unboundedPreceding, -1)
    everything = WN.Window.rowsBetween(WN.Window.unboundedPreceding, WN.Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0))
    weight = F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0))
    stopped = ranked.withColumn("__stop", F.col("__cap") * weight < F.col("__w") * rest)
    free = lambda c: F.sum(F.when(F.col("__stop"), 0).otherwise(F.col(c))).over(everything)
    taken = F.sum(F.when(F.col("__stop"), F.col("__cap")).otherwise(0)).over(everything)
    total = F.sum("source_size").over(everything)
    level = (total - taken).cast("double") * F.col("__w") / free("__w")
    return stopped.withColumn(
        "target", F.when(F.col("__stop") | (F.col("__cap") == 0), F.col("__cap").cast("double")).otherwise(level)
    ).select("__src", "__nul", "source_size", "target")


def copies(docs: DataFrame, size: Column, **options) -> DataFrame:
    """Every input row with its size, source_size, target and number of copies in the mix."""
    kept = [F.col("__row")[c].alias(c) for c in docs.columns if c not in ADDED]
    return _placed(docs, size, **options).select(*kept, *ADDED)


def _placed(
    docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED,
) -> DataFrame:
    hashable = [F.col(f.name) for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    source, name = F.col(source_col), F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.struct("*").alias("__row"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
        F.coalesce(source.cast("string"), F.lit("")).alias("__src"), source.isNull().alias("__nul"),
        F.substring(F.md5(name), 1, 3).alias("__bucket"), F.col(id_col).alias("__id"), F.xxhash64(*hashable).alias("__tie"),
    )
    digits = F.length(F.bin("size"))
    rows = rows.withColumn("__bits", digits).withColumn(
        "__top", F.expr("shiftright(size, greatest(0, length(bin(size)) - 7))")
    )
    cells = rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__size"))
    classes = cells.groupBy(*CELL[:4]).agg(F.sum("__n").alias("__n"), F.sum("__size").alias("__size"))
    sizes = classes.groupBy("__src", "__nul").agg(F.sum("__size").alias("source_size"))
    ahead = lambda by, order: F.coalesce(  # noqa: E731  rows of the cells before this one
        F.sum("__n").over(
            WN.Window.partitionBy(*by).orderBy(*order).rowsBetween(WN.Window.unboundedPreceding, -1)
        ), F.lit(0))
    classes = classes.withColumn("__base", ahead(CELL[:2], CELL[2:4])).drop("__n", "__size")
    classes = classes.join(targets(sizes, weights, limit), ["__src", "__nul"])
    cells = cells.withColumn("__in", ahead(CELL[:4], CELL[4:])).drop("__n", "__size").join(classes, CELL[:4])
    at = WN.Window.partitionBy(*CELL).orderBy("size", "__id", "__tie")
    ranked = rows.withColumn("__rank", F.row_number().over(at)).join(cells, CELL)
    offset = unit(F.concat(F.lit(seed), F.when(F.col("__nul"), "").otherwise(F.concat(F.lit(":"), F.col("__src")))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("__base") + F.col("__in") + F.col("__rank")
    crossed = F.floor(offset + place * rate) - F.floor(offset + (place - 1) * rate)
    return ranked.select(
        "__row", "size", "source_size", "target", F.least(crossed, F.lit(limit)).cast("long").alias("copies")
    )


def mix(docs: DataFrame, size: Column, **options) -> DataFrame:
    """The mix itself: each document ``copies`` times, with the input's columns."""
    out = _placed(docs, size, **options).filter("copies > 0")
    return out.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__row.*")
