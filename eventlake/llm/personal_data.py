"""Personal data by weak supervision: labelers vote, EM rates them, a classifier trained on that decides.

Candidates are spans that look like an e-mail address, an IP address, a card
or a phone number, taken by wide patterns. The strict patterns (``base``) are
always results. For every other candidate seven labelers of three kinds vote
for, against or not at all:

* regex: the strict form; a check of the digits or parts; how it is grouped;
  what it touches;
* gazetteer: issuer prefixes, country codes, top-level domains, address blocks;
* context: cue words before it; other strict spans in its document.

Expectation-maximisation over the vote patterns of all candidates of a kind
(a table of at most 3^7 rows) estimates what each labeler's vote is worth and
how likely each pattern is personal data. Those soft labels train a logistic
regression on features of the span and its surroundings, on at most about
``SAMPLE`` candidates per kind, chosen by hash; it scores every candidate.

Texts are read once; what goes on is a narrow table of candidates. Nothing of
the size of the data is shuffled or collected.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 5000  # candidates of a kind that the classifier is fitted on, about
FEATURES = 4096  # hashed features
CUE_WORDS = 4  # words before a span that may hold a cue
CUE_CHARS = 60  # characters before a span in which those words are looked for
LABELERS = ("strict", "checked", "grouped", "apart", "listed", "cued", "company")

# The strict forms.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUADS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (14, 19), (10, 15)

# Wider forms, whose matches are only candidates.
_AT = re.compile(r"([A-Za-z0-9._%+-]{1,64}) ?[\[({]? ?(?:@|at) ?[\])}]? ?([A-Za-z0-9-]{1,63}(?: ?(?:\.|[\[({] ?(?:dot|\.) ?[\])}]| dot ) ?[A-Za-z0-9-]{1,63}){1,6})")
_AT_SIGN = re.compile(r"[\[({] ?(?:at|@) ?[\])}]| at | @|@ ")
_COLONS = re.compile(r"[0-9A-Fa-f:]*+")
_NUMBER = re.compile(r"[0-9]++(?:[ .()/ ‑–-]{1,3}+[0-9]++)*+")

# Gazetteers.
_TLDS = frozenset("com org net edu gov info biz io dev app eu de fr es it nl uk us ca au ch at be pl pt se no dk fi jp cn in br mx ru".split())
_COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
                  "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "353", "358", "420")
_ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "64", "65", *(str(n) for n in range(22, 28)))
_OWN_BLOCKS = ("0.", "10.", "127.", "169.254.", "192.168.", "224.", "255.")
_CUES = {
    "email": "email e-mail mail contact write kontakt correo courriel address adresse",
    "ip": "ip host server address client from login adresse",
    "card": "card visa mastercard amex credit debit karte carte tarjeta payment",
    "phone": "phone tel telephone call fax mobile cell telefon handy telefono teléfono téléphone contact whatsapp",
}
_CUES = {kind: frozenset(words.split()) for kind, words in _CUES.items()}
_OTHER_CUES = frozenset("order invoice isbn issn page version no number nr ref id sku section figure chapter part token hash sha uuid key serial build total sum".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` of the strict spans, by start, then kind: per kind leftmost and non-overlapping."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            out.append((start, last, 0))
        at = text.find("@", max(at + 1, last))
    for m in _QUADS.finditer(text):
        if m.group().count(".") >= 3:
            parts, start = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = start + sum(map(len, four)) + 3
                if _octets(four):
                    out.append((start, end, 1))
                start = end + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = _only_digits(m.group())
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append((m.start(), m.end(), 2))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(_only_digits(m.group())) <= PHONE_DIGITS[1]:
                out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _wide_spans(text: str) -> Iterator[tuple[int, int, int]]:
    """Candidates that the strict forms leave; they may overlap those."""
    for sign in _AT_SIGN.finditer(text):
        # the name ends where the sign starts, or a space before: a bounded look back, then one match from there
        lo = sign.start()
        if text[lo - 1 : lo] == " " and text[lo] in "[({":
            lo -= 1
        while lo > 0 and sign.start() - lo < 64 and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _AT.match(text, lo)
        if m and m.end() > sign.end():
            yield m.start(), m.end(), 0
    at = text.find(":")
    while at >= 0:
        lo = at
        while lo > 0 and at - lo < 4 and text[lo - 1] in "0123456789ABCDEFabcdef":
            lo -= 1
        end = _COLONS.match(text, lo).end()
        parts = text[lo:end].split(":") if end - lo <= 39 else []
        if len(parts) > 3 and (len(parts) == 8 and all(parts) or text.count("::", lo, end) == 1 and len(parts) <= 9):
            yield lo, end, 1
        at = text.find(":", max(end, at + 1))
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() < 7:
            continue
        start, n = m.start(), sum("0" <= c <= "9" for c in m.group())
        if start and text[start - 1] in "(+":
            start -= 1
            if start and text[start] == "(" and text[start - 1] == "+":
                start -= 1
        if 12 <= n <= 19:
            yield m.start(), m.end(), 2
        if 7 <= n <= 15:
            yield start, m.end(), 3


def _vote(yes: bool, no: bool) -> int:
    return 2 if yes else 0 if no else 1


def _votes(text: str, start: int, end: int, kind: int, strict: bool, others: int) -> list[int]:
    """One vote per labeler: 2 for, 0 against, 1 abstains. ``others``: strict spans of other kinds in the document."""
    span = text[start:end]
    before, after = text[start - 1 : start], text[end : end + 1]
    apart = not (before.isalnum() or after.isalnum() or before in ("_", "=", '"') or after in ("_", "=", '"'))
    digits = _only_digits(span)
    if kind == 0:
        labels = re.split(r"[^A-Za-z0-9-]+(?:dot[^A-Za-z0-9-]+)?", span.strip("[](){} "))
        checked = _vote(labels[-1].isalpha() and len(labels[-1]) >= 2, not labels[-1].isalpha())
        grouped = _vote(bool(re.search(r"@|[\[({] ?at ?[\])}]", span)), " at " in span and "dot" not in span)
        listed = _vote(labels[-1].lower() in _TLDS, labels[-1].lower() not in _TLDS)
    elif kind == 1:
        if ":" in span:
            parts = span.split(":")
            ok = all(len(p) <= 4 for p in parts) and any(c.isdigit() for c in span)
            checked, grouped, listed = _vote(ok, not ok), _vote(len(parts) >= 5, len(parts) < 4), _vote(span[:2].lower() in ("20", "26", "2a"), span.startswith("::"))
        else:
            ok = _octets(span.split("."))
            checked = _vote(ok, not ok)
            grouped = _vote(before != "." and after != ".", before == "." and after == ".")
            listed = _vote(not span.startswith(_OWN_BLOCKS), span.startswith(_OWN_BLOCKS))
    elif kind == 2:
        ok = luhn(digits)
        checked = _vote(ok, not ok)
        sizes = [len(g) for g in re.split(r"[^0-9]+", span)]
        grouped = _vote(sizes in ([4, 4, 4, 4], [4, 6, 5], [len(digits)]), len(set(sizes)) > 3 or len(sizes) > 5)
        listed = _vote(digits.startswith(_ISSUERS) and len(digits) >= 14, not digits.startswith(_ISSUERS))
    else:
        checked = _vote(PHONE_DIGITS[0] <= len(digits) <= PHONE_DIGITS[1], len(digits) < 7 or len(digits) > 15)
        groups = len(re.findall(r"[0-9]+", span))
        grouped = _vote(2 <= groups <= 5 and bool(re.search(r"[ ()+-]", span)), groups == 1 or span.count(".") >= groups - 1 > 0)
        listed = _vote(span[:1] == "+" and digits.startswith(_COUNTRY_CODES), span[:1] == "+" and not digits.startswith(_COUNTRY_CODES))
    lead = [w.strip(".,:;()[]\"'#").lower() for w in text[max(0, start - CUE_CHARS) : start].split()[-CUE_WORDS:]]
    cued = _vote(any(w in _CUES[KINDS[kind]] for w in lead), any(w in _OTHER_CUES for w in lead))
    return [_vote(strict, not strict), checked, grouped, _vote(apart, not apart), listed, cued, _vote(others > 0, False)]


def _features(text: str, start: int, end: int, kind: int, votes: list[int]) -> list[int]:
    """Hashed features of a span and its surroundings."""
    span, name = text[start:end], KINDS[kind]
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[A-Za-z]", "a", re.sub(r"[0-9]", "9", span)))[:24]
    lead = text[max(0, start - CUE_CHARS) : start].split()[-1:] or [""]
    side = lambda c: "letter" if c.isalpha() else "digit" if c.isdigit() else "space" if c.isspace() else c
    found = [
        f"shape {shape}", f"digits {len(_only_digits(span))}", f"length {min(40, end - start) // 4}",
        f"left {side(text[start - 1 : start])}", f"right {side(text[end : end + 1])}", f"word {lead[0].lower()[:16]}",
        *(f"{labeler} {v}" for labeler, v in zip(LABELERS[1:], votes[1:])), "one",
    ]
    return [zlib.crc32(f"{name} {f}".encode()) % FEATURES for f in found]


def candidates_of(text: str) -> list[tuple]:
    """``(kind, start, end, strict, pattern, features)`` of every candidate; strict ones first of all that overlap."""
    strict = base_spans(text)
    if not strict and not any(c in text for c in "@:") and not _NUMBER.search(text) and not _AT_SIGN.search(text):
        return []
    per_kind = [0] * len(KINDS)
    for _, _, k in strict:
        per_kind[k] += 1
    # what overlaps a strict span, or a wide one that starts before, is no candidate
    taken_starts, taken_ends = [], []
    for s, e, _ in sorted(strict):
        if taken_ends and s <= taken_ends[-1]:
            taken_ends[-1] = max(e, taken_ends[-1])
        else:
            taken_starts.append(s)
            taken_ends.append(e)
    free = lambda s, e: bisect_left(taken_starts, e) == bisect_right(taken_ends, s)
    wide = [w for w in _wide_spans(text) if free(w[0], w[1])]
    out = []
    for spans, is_strict in ((strict, True), (wide, False)):
        for start, end, kind in spans:
            votes = _votes(text, start, end, kind, is_strict, len(strict) - per_kind[kind])
            pattern = sum(v * 3**i for i, v in enumerate(votes))
            out.append((kind, start, end, is_strict, pattern, _features(text, start, end, kind, votes)))
    return out


_CANDIDATE = T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("strict", T.BooleanType()), T.StructField("pattern", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.IntegerType())),
])
_ARROW = pa.struct([
    ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_()), ("pattern", pa.int32()),
    ("features", pa.list_(pa.int32())),
])

_SPAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("strict", T.BooleanType()), T.StructField("score", T.DoubleType()),
])
_ARROW_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_()), ("score", pa.float64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _ARROW]
    for batch in batches:
        texts = batch.column("text")
        found = [[dict(zip(names, c)) for c in candidates_of(texts[r].as_py() or "")] for r in range(batch.num_rows)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, pa.list_(_ARROW))], names=["row", "found"])


def reliabilities(counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns: rows (pattern, count) -> P(personal) by row, P(vote | class), P(class).

    Labelers vote independently given the class. Every labeler starts as somewhat better than chance and keeps that
    as a prior of ten votes, so the classes cannot change places and a kind of one class stays one.
    """
    votes = (counts[:, :1] // 3 ** np.arange(len(LABELERS))) % 3
    n = counts[:, 1].astype(np.float64)
    chance = np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]])  # P(against, none, for) for other spans and personal data
    table = np.repeat(chance[:, None, :], len(LABELERS), axis=1)  # class, labeler, vote
    prior, each = 0.5, np.arange(len(LABELERS))
    posterior = np.full(len(n), 0.5)
    for _ in range(rounds):
        like = np.log(table[:, each, votes]).sum(axis=2)
        odds = np.clip(like[1] - like[0] + np.log(prior / (1 - prior)), -30, 30)
        before, posterior = posterior, 1 / (1 + np.exp(-odds))
        for y, weight in ((0, n * (1 - posterior)), (1, n * posterior)):
            for v in range(3):
                table[y, :, v] = (votes == v).T @ weight + 10 * chance[y, v]
        table /= table.sum(axis=2, keepdims=True)
        prior = ((n * posterior).sum() + 1) / (n.sum() + 2)
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
    return posterior, table, prior


def train(features: np.ndarray, target: np.ndarray, rounds: int = 300, decay: float = 1e-3) -> np.ndarray:
    """Weights of a logistic regression on hashed features with soft targets (gradient descent with momentum)."""
    weight, speed = np.zeros(FEATURES), np.zeros(FEATURES)
    if not len(target):
        return weight
    seen = np.bincount(features.ravel(), minlength=FEATURES)
    rate = 4.0 / (seen + len(target) * decay + 1)  # by feature: rare ones learn as fast as common ones
    for _ in range(rounds):
        error = target - 1 / (1 + np.exp(-np.clip(weight[features].sum(axis=1), -30, 30)))
        slope = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), FEATURES) - decay * len(target) * weight
        speed = 0.8 * speed + rate * slope / features.shape[1]
        weight += speed
    return weight


def fit(found: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """The classifier's weights, from the vote patterns of all candidates and a bounded sample of their features."""
    each = found.select(F.explode("found").alias("c"), F.xxhash64("row").alias("h")).select("c.*", "h")
    counted = each.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 4 * 3^7 rows
    weights = np.zeros(FEATURES)
    soft, rates = {}, {}
    for kind in range(len(KINDS)):
        rows = np.array(sorted((r["pattern"], r["n"]) for r in counted if r["kind"] == kind), dtype=np.int64).reshape(-1, 2)
        if len(rows):
            posterior, _, _ = reliabilities(rows)
            soft |= {(kind, p): v for p, v in zip(rows[:, 0].tolist(), posterior.tolist())}
            rates[kind] = min(1.0, sample / rows[:, 1].sum())
    if not rates:
        return weights
    rate = F.element_at(F.create_map(*[F.lit(x) for kv in rates.items() for x in kv]), F.col("kind"))
    place = F.pmod(F.xxhash64("h", "start", "kind"), F.lit(1 << 20)) / (1 << 20)
    picked = each.where(place < rate).select("kind", "pattern", "features", "h", "start")
    picked = picked.limit(16 * sample).collect()  # about 4 * sample rows; more only where rows repeat without an id
    picked.sort(key=lambda r: (r["kind"], r["pattern"], r["h"], r["start"], r["features"]))
    features = np.array([r["features"] for r in picked], dtype=np.int64).reshape(len(picked), -1)
    return train(features, np.array([soft[r["kind"], r["pattern"]] for r in picked]))


def personal_data(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Every row of ``docs`` without its text, packed as ``row``, with its ``spans`` by start, then kind.

    A span is (kind, start, end, strict, score): code points, end exclusive; kind as in ``KINDS``. Strict spans have
    score 1. Added ones overlap no strict span and have the classifier's score, 0.5 or more.

    A null, empty or clean text has an empty list. Rows are independent, so repeated rows have equal results, and
    columns cannot clash, being packed. An empty table gives an empty one. A long text is scanned whole, in linear
    time. A table without candidates leaves the classifier untrained; it then adds nothing.
    """
    rest = [c for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*rest).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([packed.schema["row"], T.StructField("found", T.ArrayType(_CANDIDATE))])
    found = cut(packed.mapInArrow(_find, schema), "personal-data")
    weights = fit(found, sample)
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for some in batch.column("found").to_pylist():
                spans, reach = [], {}
                for c in some:
                    score = 1.0 if c["strict"] else float(1 / (1 + np.exp(-weights[c["features"]].sum())))
                    if c["strict"] or score > 0.5:
                        spans.append((c["start"], c["kind"], c["end"], c["strict"], score))
                kept = []
                for s in sorted(spans):
                    # of added spans that overlap, the first stays, of two at one place the likelier kind
                    if not s[3]:
                        if s[0] < reach.get("end", 0):
                            if s[0] == kept[-1][0] and not kept[-1][3] and s[4] > kept[-1][4]:
                                kept.pop()
                            else:
                                continue
                        reach["end"] = s[2]
                    kept.append(s)
                out.append([{"kind": KINDS[k], "start": a, "end": e, "strict": b, "score": v} for a, k, e, b, v in kept])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.list_(_ARROW_SPAN))], names=["row", "spans"])

    result = T.StructType([packed.schema["row"], T.StructField("spans", T.ArrayType(_SPAN))])
    return found.mapInArrow(decide, result)
