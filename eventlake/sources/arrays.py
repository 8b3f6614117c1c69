"""Large JSON-array files, read by many tasks.

A file that holds one JSON array of events has no line structure, but Spark's
text source can cut it at any character: with ``lineSep=","`` it is split by
byte ranges like any text file, in any file system, and each task streams the
pieces between commas of its range. What a piece means depends on what stands
before it (inside a string? how deep?), so the file is read twice:

1. every range is summed up as a function of its entry state: whether it
   changes sides of a quote, and the change of depth for either side. A range
   is one row of metadata; composing them in file order (a prefix scan) gives
   every range's entry state.
2. every range, knowing its state, cuts its pieces into elements: a comma at
   depth one outside strings ends one. Elements that reach over ranges come
   out as fragments, at most two a range, and are joined by a small grouping.

No bytes are shuffled but those of the elements, written once for validation.
The result is the same as that of reading the file as one document
(:func:`eventlake.sources.files.explode_documents`).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .files import explode_documents, lenient_value, read_documents, strict_value

# A file up to this size is one document for one task.
WHOLE_BYTES = 32 << 20
# Of a large document that is no JSON, this much (in characters) is kept to be dead-lettered.
KEPT_OF_BAD = 4096

_QUOTE, _SLASH, _COMMA = 34, 92, 44
_DELTA = np.zeros(256, dtype=np.int8)
_DELTA[[ord("["), ord("{")]] = 1
_DELTA[[ord("]"), ord("}")]] = -1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 13]] = True  # the white space of JSON

_RANGE = "path string, at long, size long, flips boolean, outside long, inside long, bytes long, first int"
_PART = "path string, at long, n long, starts boolean, ends boolean, text binary, bad boolean"


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and piece offsets (n + 1) of an Arrow binary array."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _quoted(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of string quotes up to and including each byte: odd means inside, counted from an outside start.

    A quote after an odd run of backslashes is escaped; a run ends with its piece (``\\,`` is no JSON).
    """
    quote = raw == _QUOTE
    slash = np.flatnonzero(raw == _SLASH)
    if len(slash):
        fresh = np.ones(len(slash), dtype=bool)
        fresh[1:] = (np.diff(slash) != 1) | np.isin(slash[1:], offsets)
        start = slash[np.maximum.accumulate(np.where(fresh, np.arange(len(slash)), 0))]
        odd = slash[((slash - start) % 2 == 0)] + 1
        odd = odd[(odd < len(raw)) & ~np.isin(odd, offsets)]
        quote[odd] = False
    return np.cumsum(quote, dtype=np.int64)


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], pa.Array]]:
    """Pieces of one range at a time, in order (a task may hold several ranges)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, at, size = (batch.column(c) for c in ("path", "at", "size"))
        at_ = at.to_numpy()
        codes = path.dictionary_encode().indices.to_numpy()
        edges = (np.flatnonzero((np.diff(at_) != 0) | (np.diff(codes) != 0)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, batch.num_rows]):
            yield (path[lo].as_py(), int(at_[lo]), size[lo].as_py()), batch.column("value").slice(lo, hi - lo)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a range: its effect on the state, for an entry outside or inside a string."""
    rows: dict = {}
    for key, column in _by_range(batches):
        raw, offsets = _bytes(column)
        got = rows.setdefault(key, {"flips": 0, "outside": 0, "inside": 0, "bytes": 0, "first": None})
        quotes = _quoted(raw, offsets)
        step = _DELTA[raw].astype(np.int64)
        odd = quotes % 2 == 1
        deltas = [int(step[~odd].sum()), int(step[odd].sum())]
        side = got["flips"]
        got["outside"] += deltas[side]
        got["inside"] += deltas[1 - side]
        got["flips"] = (side + int(quotes[-1] if len(quotes) else 0)) % 2
        got["bytes"] += len(raw) + len(column)  # each piece ended with a comma, but the last of the file
        if got["first"] is None:
            solid = np.flatnonzero(~_BLANK[raw])
            if len(solid):
                got["first"] = int(raw[solid[0]])
            elif len(column) > 1:
                got["first"] = _COMMA
    if rows:
        keys = list(rows)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64()), pa.array([k[2] for k in keys], pa.int64()),
                pa.array([bool(rows[k]["flips"]) for k in keys]), *(pa.array([rows[k][c] for k in keys], pa.int64()) for c in ("outside", "inside", "bytes")),
                pa.array([rows[k]["first"] for k in keys], pa.int32()),
            ],
            names=["path", "at", "size", "flips", "outside", "inside", "bytes", "first"],
        )


def entry_states(ranges: list) -> dict[tuple[str, int], dict]:
    """From the ranges' rows the state at the entry of each: ``inside`` a string, ``depth``, and what its file is.

    A file that does not start with ``[`` is one message: its depths count from one, as if in an array.
    ``whole`` says that the file ends outside strings at the depth it has to, without a comma.
    """
    files: dict[str, list] = {}
    for r in ranges:
        files.setdefault(r["path"], []).append(r)
    out = {}
    for path, rows in files.items():
        rows.sort(key=lambda r: r["at"])
        first = next((r["first"] for r in rows if r["first"] is not None), None)
        array = first == ord("[")
        inside, depth = False, 0 if array else 1
        for r in rows:
            out[path, r["at"]] = {"inside": inside, "depth": depth, "array": array, "opens": r is rows[0]}
            depth += r["inside"] if inside else r["outside"]
            inside ^= r["flips"]
        # a file's last comma is not handed out: pieces then add up to the file's size, not to one more
        comma = sum(r["bytes"] for r in rows) in (rows[0]["size"], rows[0]["size"] - 3)  # less a byte order mark
        for r in rows:
            out[path, r["at"]] |= {"whole": not inside and depth == (0 if array else 1) and not comma, "comma": comma}
    return out


def _cut_elements(states: dict[tuple[str, int], dict]):
    """The task of the second reading: complete elements, and the fragments at a range's ends."""

    def row(key, n, starts, ends, text, bad):
        return {"path": key[0], "at": key[1], "n": n, "starts": starts, "ends": ends, "text": text, "bad": bad}

    def finish(key, state) -> Iterator[dict]:
        # what is left at the end of a range goes on in the next one, or ends the file
        text = b",".join(state["open"]) if state["open"] else None
        if text is not None:
            yield row(key, state["n"], state["starts"], False, text, state["bad"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "at", "n", "starts", "ends", "text", "bad"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.bool_()]
        pack = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, kinds)], names=names)
        current, state = None, {}
        for key, column in _by_range(batches):
            out: list[dict] = []
            if key != current:
                if current:
                    out += finish(current, state)
                if key[:2] not in states:
                    raise RuntimeError(f"{key[0]} was split otherwise in its first reading; read it again")
                entry = states[key[:2]]
                fresh = entry["opens"] or (not entry["inside"] and entry["depth"] == 1)
                state = {"inside": entry["inside"], "depth": entry["depth"], "open": [], "n": 0, "starts": fresh,
                         "head": entry["opens"] and entry["array"], "array": entry["array"], "bad": False, "closed": False}
                current = key
            raw, offsets = _bytes(column)
            quotes = _quoted(raw, offsets) + state["inside"]
            step = np.where(quotes % 2 == 0, _DELTA[raw], 0).astype(np.int64)
            depth = state["depth"] + np.cumsum(step)
            ends = offsets[1:] - 1  # the last byte of each piece; an empty piece keeps the state before it
            outside = np.where(ends >= 0, quotes[np.maximum(ends, 0)] % 2 == 0 if len(quotes) else not state["inside"], not state["inside"])
            level = np.where(ends >= 0, depth[np.maximum(ends, 0)] if len(depth) else state["depth"], state["depth"])
            splits = outside & (level == 1)
            # the array closes where the depth falls to zero: only its bracket, then blanks, may end the file
            shut = np.flatnonzero((depth == 0) & (step < 0)) if state["array"] else np.empty(0, np.int64)
            body = raw.tobytes()
            for i in range(len(column)):
                lo, hi = int(offsets[i]), int(offsets[i + 1])
                text = body[lo:hi]
                if state["head"]:
                    if not text.strip(b" \t\r\n") and not state["open"]:
                        state["bad"] = True  # a comma before the array
                    lead = text.find(b"[")
                    text, state["head"] = text[lead + 1 :], False
                    lo += lead + 1
                if state["closed"]:
                    state["bad"] = True  # something follows the array
                at = shut[np.searchsorted(shut, lo) :][:1]
                if len(at) and at[0] < hi:
                    end = int(at[0])
                    state["closed"] = True
                    if raw[end] != ord("]") or not _BLANK[raw[end + 1 : hi]].all():
                        state["bad"] = True
                    text = body[lo:end]
                state["open"].append(text)
                if splits[i] and i + 1 <= len(column):
                    out.append(row(key, state["n"], state["starts"], True, b",".join(state["open"]), state["bad"]))
                    state |= {"open": [], "n": state["n"] + 1, "starts": True}
            if len(quotes):
                state["inside"], state["depth"] = bool(quotes[-1] % 2), int(depth[-1])
            if out:
                yield pack(out)
        if current and (rest := list(finish(current, state))):
            yield pack(rest)

    return work


@contextmanager
def _split_size(spark: SparkSession, split_bytes: int | None):
    """Jobs inside read files in ranges of at most ``split_bytes``."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        if split_bytes:
            for n in names:
                spark.conf.set(n, str(split_bytes))
        yield
    finally:
        for n in names:
            spark.conf.set(n, before[n])


def scan_arrays(spark: SparkSession, paths: list[str], split_bytes: int | None = None) -> DataFrame:
    """``(path, pos, value)``: the events of the array files ``paths``, each file read by many tasks.

    Same rows as reading each file as a document: an array gives its elements in order, any other single value gives
    itself, and a file that is no JSON, cut off for instance, gives one row that dead-letters (its first characters
    where it is long) and no event. Elements that only the lenient JSON reader accepts (``NaN``) cost no other one.
    Strings in single quotes are not understood: such a file is no JSON. An element, like the message that it is,
    has to fit a task's memory.
    """
    lines = spark.read.option("lineSep", ",").text(paths).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("at"), F.col("_metadata.file_size").alias("size"))
    with _split_size(spark, split_bytes):
        # one row a range: file metadata, not data
        states = entry_states(lines.mapInArrow(_sum_up, _RANGE).collect())
        stored = scratch_path(spark, "array-parts")
        lines.mapInArrow(_cut_elements(states), _PART).write.parquet(stored)
    parts = spark.read.schema(_PART).parquet(stored)
    broken = sorted({path for (path, _), s in states.items() if not s["whole"]})

    # fragments of an element that reaches over ranges: from one that starts it up to the next start
    whole = parts.where("starts AND ends").select("path", "at", "n", "text", "bad")
    order = Window.partitionBy("path").orderBy("at", "n")  # at most two rows a range
    pieces = parts.where("NOT (starts AND ends)").withColumn("e", F.sum(F.col("starts").cast("int")).over(order))
    joined = pieces.groupBy("path", "e").agg(
        F.sort_array(F.collect_list(F.struct("at", "n", "text"))).alias("f"), F.max("bad").alias("bad"))
    joined = joined.select("path", F.col("f")[0]["at"].alias("at"), F.col("f")[0]["n"].alias("n"),
                           F.encode(F.array_join(F.transform("f", lambda x: F.decode(x["text"], "utf-8")), ","), "utf-8").alias("text"), "bad")
    elements = whole.unionByName(joined).withColumn("value", F.decode("text", "utf-8"))

    # strict JSON as it is, what only the lenient reader accepts as that reads it
    element = elements.select("path", "at", "n", "bad", "value", strict_value(F.col("value")).alias("strict"))
    blank = F.trim(F.regexp_replace("value", r"[\t\r\n]", " ")) == ""
    value = F.when(F.col("strict").isNotNull(), F.to_json("strict")).otherwise(lenient_value(F.col("value"), "string"))
    element = element.select("path", "at", "n", "bad", blank.alias("blank"), F.when(~blank, value).alias("value"))
    from ..sinks.tables import materialize

    element = materialize(element, "array-elements")
    # a file of one blank element is an empty array; any other blank or unreadable element spoils its file
    verdict = element.groupBy("path").agg(F.count(F.lit(1)).alias("n_all"), F.count_if("blank").alias("n_blank"),
                                          F.count_if(F.col("bad") | (F.col("value").isNull() & ~F.col("blank"))).alias("n_bad"))
    kind = {path: s["array"] for (path, _), s in states.items()}
    single = F.col("path").isin([p for p, array in kind.items() if not array])
    spoiled = F.col("path").isin(broken) | (F.col("n_bad") > 0) | ((F.col("n_blank") > 0) & ((F.col("n_all") > 1) | single)) | (single & (F.col("n_all") > 1))
    verdict = verdict.select("path", spoiled.alias("spoiled"))
    counts = element.groupBy("path", "at").agg(F.count(F.lit(1)).alias("k"))  # a row per range
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("path", "at", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("offset"))
    rank = element.where("NOT blank").join(verdict, "path").where("NOT spoiled").join(counts, ["path", "at"])
    # of a range's rows the numbers run from its first element; a joined one has the number of its first fragment
    first = element.groupBy("path", "at").agg(F.min("n").alias("least"))
    good = rank.join(first, ["path", "at"]).select("path", (F.col("offset") + F.col("n") - F.col("least")).alias("pos"), "value")
    bad = [r["path"] for r in verdict.where("spoiled").collect()]  # files, of those named by the caller
    if not bad:
        return good
    heads = spark.read.option("lineSep", ",").text(bad).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.col("_metadata.file_size").alias("size"),
        F.left("value", F.lit(KEPT_OF_BAD)).alias("value"), F.monotonically_increasing_id().alias("i")).where("at = 0")
    top = Window.partitionBy("path").orderBy("i")
    heads = heads.withColumn("r", F.row_number().over(top)).where(F.col("r") <= KEPT_OF_BAD).groupBy("path", "size").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "value"))), lambda x: x["value"]), ",").alias("value"))
    commas = sorted({path for (path, _), s in states.items() if s["comma"]})
    kept = F.when(F.length("value") > KEPT_OF_BAD, F.concat(F.left("value", F.lit(KEPT_OF_BAD)), F.lit("…")))
    kept = kept.when(F.col("path").isin(commas), F.concat("value", F.lit(","))).otherwise(F.col("value"))
    return good.unionByName(heads.select("path", F.lit(0).cast("long").alias("pos"), kept.alias("value")))


def read_arrays(spark: SparkSession, folder: str, glob: str | None = None, whole_bytes: int = WHOLE_BYTES,
                split_bytes: int | None = None) -> DataFrame:
    """``(path, pos, value)``: the events of all array files under ``folder``.

    Files up to ``whole_bytes`` are documents of one task each, larger ones are read by ranges. Only the large files'
    names come to the driver.
    """
    listing = spark.read.format("binaryFile")
    if glob:
        listing = listing.option("pathGlobFilter", glob)
    files = listing.load(folder).select("path", "length")
    large = [r["path"] for r in files.where(F.col("length") > whole_bytes).select("path").collect()]
    small = read_documents(spark, folder, glob, max_bytes=whole_bytes)
    out = explode_documents(small).select("path", F.col("pos").cast("long").alias("pos"), "value")
    return out.unionByName(scan_arrays(spark, large, split_bytes)) if large else out
