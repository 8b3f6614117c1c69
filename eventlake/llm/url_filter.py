"""URL filters over time: dated list entries become validity intervals, joined as of each capture.

A list entry says that from its day on a key is added to or removed from a
list. Entries of one list and key become the non-overlapping intervals in which
the key was listed (``intervals``). A capture looks up its keys - exact URL,
host, and every parent domain of the host - and is evaluated against the
entries active on the day it was fetched.

Lists are dated by the day, so a key has one interval per two days at most. An
interval is cut at month ends and joined on (key, month), so a key with very
many entries, and a host with very many captures, meets in pieces of one month:
at most 16 intervals per list for a capture. Captures are first counted per
(key, day); the join runs on those counts' keys, not on captures, and each
verdict comes back to its captures by an equi-join that Spark may split.

Defined results: entries of one list and key on one day count as the one with
the greatest sequence number (on a tie, a removal); an interval holds its first
day and not its last; a null or unparsable URL has no keys and is allowed; a
null day matches no entry; repeated captures each get the verdict; captures on
an empty list are allowed. ``allow`` beats ``block``. Columns named like an
added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as WN

HORIZON = "9999-12-31"  # end of an interval that is still open
ADDED = ("n_block", "n_allow", "blocked")


def canonical(url) -> Column:
    """Scheme, user, port, query, fragment and a trailing slash dropped; host in lower case."""
    c = F.regexp_replace(F.trim(F.col(url)), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    c = F.regexp_replace(c, r"[?#].*$", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(c, r"^([^/]*)", 1), r"^.*@|:[0-9]*$", ""))
    path = F.regexp_replace(F.regexp_extract(c, r"^[^/]*(.*)$", 1), r"/+$", "")
    return F.concat(host, path)


def host_of(url) -> Column:
    return F.regexp_extract(canonical(url), r"^([^/]*)", 1)


def keys_of(url) -> Column:
    """The keys a URL is looked up by: itself, its host and the host's parent domains of two labels or more."""
    labels = F.split(host_of(url), r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    both = F.array_distinct(F.concat(F.array(canonical(url)), parents))
    return F.filter(F.coalesce(both, F.array()), lambda k: k != "")


def intervals(entries: DataFrame) -> DataFrame:
    """``list, key, valid_from, valid_to`` from entries ``list, key, action (add/remove), day, seq``."""
    known = entries.dropna(subset=["list", "key", "action", "day"])
    day = known.groupBy("list", "key", "day").agg(
        F.max(F.struct(F.coalesce("seq", F.lit(-1)), (F.col("action") != "add").alias("gone"))).alias("last")
    )
    by_day = WN.Window.partitionBy("list", "key").orderBy("day")
    steps = day.withColumn("valid_to", F.coalesce(F.lead("day").over(by_day), F.lit(HORIZON).cast("date")))
    return steps.filter(~F.col("last.gone")).select("list", "key", F.col("day").alias("valid_from"), "valid_to")


def _month(day: Column) -> Column:
    return (F.year(day) * 12 + F.month(day)).cast("int")


def evaluate(captures: DataFrame, entries: DataFrame, url_col: str = "url", day_col: str = "day") -> DataFrame:
    """Every capture with the number of block and allow entries active when it was fetched, and the verdict."""
    kept = [c for c in captures.columns if c not in ADDED]
    rows = captures.select(
        F.struct(*kept).alias("__row"), F.coalesce(F.col(url_col), F.lit("")).alias("__url"), F.col(day_col).alias("__day")
    )
    wanted = rows.select("__url", "__day").distinct()
    looked = wanted.dropna().select("__url", "__day", F.explode(keys_of("__url")).alias("key"))
    asked = looked.groupBy("key", "__day").agg(F.lit(1).alias("one")).select("key", "__day", _month(F.col("__day")).alias("month"))
    # months after the last capture are of no use, so an open interval ends there
    last = F.lit(captures.agg(F.max(day_col)).first()[0]).cast("date")
    until = F.least(F.date_sub("valid_to", 1), last)
    spans = intervals(entries).filter(F.col("valid_from") <= last).select(
        "list", "key", "valid_from", "valid_to", F.explode(F.sequence(_month(F.col("valid_from")), _month(until))).alias("month")
    )
    active = asked.join(spans, ["key", "month"]).filter("valid_from <= __day AND __day < valid_to")
    state = active.groupBy("key", "__day").agg(
        F.count(F.when(F.col("list") == "block", 1)).alias("n_block"), F.count(F.when(F.col("list") == "allow", 1)).alias("n_allow")
    )
    verdict = looked.join(state, ["key", "__day"]).groupBy("__url", "__day").agg(
        F.sum("n_block").alias("n_block"), F.sum("n_allow").alias("n_allow")
    )
    block, allow = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_block", "n_allow"))
    return rows.join(verdict, ["__url", "__day"], "left").select(
        "__row.*", block.alias("n_block"), allow.alias("n_allow"), ((block > 0) & (allow == 0)).alias("blocked")
    )
