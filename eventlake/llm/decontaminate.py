"""Benchmark decontamination by template canonicalisation.

Words lose punctuation and case, and typed placeholders replace numbers
(``12``), quantities (``5kg``), units after a number (``5 kg``) and
capitalised words (names; sentence-initial words too, so a question that starts
with another name still matches). A run of names is one placeholder, and so is
a number with its unit. A template window is ``window`` consecutive
tokens (an item shorter than that is one window); those with fewer than
``literals`` plain words say too little. Beside them the windows of the plain
words are compared, so that copies in another case are found.

Windows of the benchmark fill a bitmap of fixed size (2 MB), broadcast; document
windows that hit it are joined with the benchmark's windows by hash. Matches of
one document and item that lie on one alignment (same shift, or neighbouring
shifts, as a name of more words moves what follows it) are checked for
slot consistency: every slot value of the item must stand for one value in the
document, allowing a fifth of the slot pairs to disagree. An item is found in a
document when one alignment has at least ``least`` consistent windows at different places of the
item (or all windows of a shorter item).

Defined results: null or empty texts and items match nothing; a null id is kept
as null; rows that repeat id and text give one result; repeated items each
match; ties between alignments go to the smallest shift; case is folded for
ASCII and Latin-1 letters; only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import ROLL_A, ROLL_B, U64, _BYTES, buffers, cut, inside, mix, row_groups, slices, word_spans
from .spans import KEY, keyed, with_key

WINDOW = 8
LITERALS = 4
LEAST = 6
DISAGREE = 0.2
SHIFTS = 8  # shifts no further apart than this are always in one band
BITS = 24
NUM, QUANTITY, UNIT, NAME = 1, 2, 3, 4

# Units written as words of their own or behind a number; fixed values.
UNITS = (
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer "
    "kilometers kilometre kilometres mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces "
    "ton tons ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour "
    "hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees "
    "mph kmh km2 m2 m3 hz khz mhz kb mb gb tb w kw v"
)

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LOWER = ((_B >= 97) & (_B <= 122)) | (_B >= 128)
_DIGIT = (_B >= 48) & (_B <= 57)
_KEEP = _UPPER | _LOWER | _DIGIT
_FOLD = np.where(_UPPER, _B + 32, _B).astype(np.uint8)
ROWS = "doc long, tag long, null_id boolean, at int, size int, hash long, slots array<long>"


def _per_word(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[ends] - total[starts]


def _hashes(folded: np.ndarray, keep: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's kept bytes."""
    place = np.concatenate([[0], np.cumsum(keep)])
    prefix = ROLL_A.prefix(_BYTES[folded[keep]])
    return ROLL_A.spans(prefix, place[starts], place[ends]) + (place[ends] - place[starts]).astype(np.uint64)


def tokens(raw: np.ndarray, offsets: np.ndarray, units: np.ndarray | None = None):
    """Per word: hash and kind of slot (0: a plain word); and each row's first word."""
    plain, kinds, places = [], [], []
    units = _unit_hashes() if units is None else units
    for lo, hi, starts, ends in word_spans(raw, offsets):
        b = raw[lo:hi]
        after = np.append(b[1:], 0)
        capital = (b == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)  # Latin-1 capitals
        folded = _FOLD[b]
        folded[1:] += (capital[:-1] * 0x20).astype(np.uint8)
        upper = _UPPER[b] | capital
        lower = _LOWER[b] & ~capital
        lower[1:] &= ~capital[:-1]
        keep, digit = _KEEP[b], _DIGIT[b]
        kept = _per_word(keep, starts, ends)
        starts, ends = starts[kept > 0], ends[kept > 0]
        if not len(starts):
            continue
        h = _hashes(folded, keep, starts, ends)
        n_upper, n_lower, n_digit = (_per_word(x, starts, ends) for x in (upper, lower, digit))
        first_kept = np.flatnonzero(keep)[np.concatenate([[0], np.cumsum(keep)])[starts]]
        kind = np.zeros(len(h), np.int64)
        kind[upper[first_kept] & (n_lower > 0)] = NAME
        kind[(n_digit > 0) & (n_upper + n_lower == 0)] = NUM
        mixed = np.flatnonzero((n_digit > 0) & (n_upper + n_lower > 0))
        if len(mixed):
            letters = _hashes(folded, keep & ~digit, starts[mixed], ends[mixed])
            kind[mixed] = np.where(np.isin(letters, units), QUANTITY, 0)
        plain.append(h)
        kinds.append(kind)
        places.append(starts + lo)
    if not plain:
        none = np.empty(0, np.uint64)
        return none, none.astype(np.int64), np.zeros(len(offsets), np.int64)
    h, kind, place = np.concatenate(plain), np.concatenate(kinds), np.concatenate(places)
    first = np.searchsorted(place, offsets).astype(np.int64)
    unit = np.flatnonzero(np.isin(h, units))
    unit = unit[(unit > 0) & ~np.isin(unit, first)]
    kind[unit[kind[unit - 1] == NUM]] = UNIT
    return h, kind, first


def templates(h: np.ndarray, kind: np.ndarray, first: np.ndarray):
    """Per template token: hash, slot value (0: a plain word) and first word; and each row's first token.

    A run of names is one token, and so is a number with its unit, so that a longer name or ``5kg`` for ``5 kg`` moves
    nothing.
    """
    joined = np.zeros(len(h), bool)
    joined[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) | (kind[1:] == UNIT) & (kind[:-1] == NUM)
    joined[first[first < len(h)]] = False
    starts = np.flatnonzero(~joined)
    ends = np.append(starts[1:], len(h)).astype(np.int64)
    of = np.where((kind[starts] == NUM) & (ends - starts > 1), QUANTITY, kind[starts]).astype(np.uint64)
    value = ROLL_A.spans(ROLL_A.prefix(h), starts, ends[: len(starts)])
    template = np.where(of > 0, mix(of), h[starts])
    slot = np.where(of > 0, mix(value + of) | U64(1), U64(0))
    return template, slot, starts, np.searchsorted(starts, first).astype(np.int64)


def _unit_hashes() -> np.ndarray:
    raw = np.frombuffer(UNITS.encode(), np.uint8)
    return tokens(raw, np.array([0, len(raw)]), np.empty(0, np.uint64))[0]


def _windows(text: pa.Array, lengths: list[int], literals: int, whole: int = 0):
    """Per slice and window length: hash, row, place and slots of every window inside one row.

    Windows of plain words, whatever their case and without slots, and windows of template tokens that have a slot and
    enough plain words. Places are in words.

    ``whole``: benchmark items shorter than it are one window of their own length, and longer
    ones have windows of that length only.
    """
    raw, offsets = buffers(text)
    units = _unit_hashes()
    for lo, hi in row_groups(offsets):
        part = offsets[lo : hi + 1] - offsets[lo]
        plain, kind, words = tokens(raw[offsets[lo] : offsets[hi]], part, units)
        template, slots, starts, heads = templates(plain, kind, words)
        streams = ((ROLL_B, plain, np.zeros(len(plain), np.uint64), np.arange(len(plain)), words), (ROLL_A, template, slots, starts, heads))
        for size, (roll, values, slot, place, first) in ((x, y) for x in lengths for y in streams):
            for at, end in slices(len(values), size):
                start = np.arange(end - at - size + 1)
                row, valid = inside(first, at, start, size)
                if whole:
                    count = (first[1:] - first[:-1])[row]
                    valid &= (count == size) | ((size == whole) & (count > size))
                if roll is ROLL_A:
                    free = np.concatenate([[0], np.cumsum(slot[at:end] == 0)])
                    n = free[start + size] - free[start]
                    valid &= (n >= literals) & (n < size)
                start, row = start[valid], row[valid]
                if not len(start):
                    continue
                h = roll.spans(roll.prefix(values[at:end]), start, start + size) + U64(size)
                yield size, h, lo + row, place[start + at] - words[row], start + at, slot


def _rows(lengths: list[int], literals: int, whole: int = 0, bitmap=None):
    """Windows as rows; of documents only those that hit the bitmap."""

    def run(batches):
        for batch in batches:
            doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            null = batch.column("null_id").to_numpy(zero_copy_only=False)
            for size, h, row, at, place, slot in _windows(batch.column("text"), lengths, literals, whole):
                i = np.arange(len(h)) if bitmap is None else np.flatnonzero(sketch.repeated(bitmap.value, h, BITS))
                for i in np.array_split(i, len(i) // 20_000 + 1):
                    if len(i):
                        grid = slot[place[i][:, None] + np.arange(size)]
                        values = pa.array(grid.ravel().view(np.int64))
                        slots = pa.ListArray.from_arrays(pa.array(np.arange(len(i) + 1) * size, pa.int32()), values)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc[row[i]]), pa.array(tag[row[i]]), pa.array(null[row[i]]), pa.array(at[i], pa.int32()),
                             pa.array(np.full(len(i), size), pa.int32()), pa.array(h[i].view(np.int64)), slots],
                            names=[x.strip().split(" ")[0] for x in ROWS.split(",")],
                        )

    return run


def _lengths(window: int):
    """Distinct token counts below the window, one small row per task and count."""

    def run(batches):
        found = set()
        for batch in batches:
            raw, offsets = buffers(batch.column("text"))
            h, kind, words = tokens(raw, offsets)
            for count in (np.diff(words), np.diff(templates(h, kind, words)[3])):
                found |= set(count[(count > 0) & (count < window)].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["size"])

    return run


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, literals: int = LITERALS, least: int = LEAST, disagree: float = DISAGREE,
) -> DataFrame:
    """Found (document, item) pairs: doc, tag, null_id, item, windows matched, windows of the item, shift."""
    items = keyed(benchmark, item_col, item_text_col)
    short = items.mapInArrow(_lengths(window), "size int").distinct().collect()
    lengths = sorted({window, *(r.size for r in short)})
    own = cut(items.mapInArrow(_rows(lengths, literals, window), ROWS), "benchmark-windows")

    def hashes(batches):
        for batch in batches:
            yield batch.column("hash").to_numpy().view(np.uint64)

    filled = docs.sparkSession.sparkContext.broadcast(sketch.build(own.select("hash"), hashes, BITS, 1, least=1))
    key = KEY
    found = keyed(docs, id_col, text_col).mapInArrow(_rows(lengths, literals, bitmap=filled), ROWS)
    total = own.groupBy(*key).agg(F.count_distinct("at").alias("item_windows"))
    item = own.join(total, key).select(
        "hash", "size", F.struct(*key).alias("item"), "item_windows", F.col("at").alias("item_at"), F.col("slots").alias("item_slots")
    )
    match = found.join(item, ["hash", "size"]).withColumn("shift", F.col("at") - F.col("item_at"))
    pairs = F.filter(F.arrays_zip("item_slots", "slots"), lambda x: x["item_slots"] != 0)
    # one shift, and two bands of neighbouring shifts: a change in the number of words moves what follows it
    band = F.floor(F.col("shift") / SHIFTS)
    line = F.array(*(F.struct(F.lit(k).alias("kind"), no.cast("long").alias("no")) for k, no in ((0, F.col("shift")), (1, band), (1, band + 1))))
    match = match.withColumn("line", F.explode(line))
    lined = match.groupBy(*key, "item", "item_windows", "line").agg(
        F.min("shift").alias("shift"), F.count_distinct("item_at").alias("windows"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    values = F.size(F.array_distinct(F.transform("pairs", lambda x: x["item_slots"])))
    good = (F.size("pairs") - values) <= F.lit(disagree) * F.size("pairs")
    enough = F.col("windows") >= F.least(F.lit(least), F.col("item_windows"))
    best = F.max(F.struct("windows", (-F.col("shift")).alias("back")))
    out = lined.filter(good & enough).groupBy(*key, "item", "item_windows").agg(best.alias("best"))
    return out.select(
        *key, F.when(~F.col("item.null_id"), F.col("item.doc")).alias("item"),
        F.col("best.windows").alias("windows"), "item_windows", (-F.col("best.back")).alias("shift"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input rows without those that hold a benchmark item."""
    bad = contaminated(docs, benchmark, id_col, text_col, **options).select(*KEY).distinct()
    return with_key(docs, id_col, text_col).join(bad.hint("shuffle_hash"), KEY, "left_anti").select("row.*")
