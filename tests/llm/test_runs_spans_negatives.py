"""Periodic runs, personal data and hard negatives against brute force, and their awkward inputs."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventlake.llm import hard_negatives as H
from eventlake.llm import periodic_runs as R
from eventlake.llm import personal_data as D
from eventlake.llm.queries import QUERIES

from .helpers import SCHEMA, awkward, frame, rows, words

# --- periodic runs -----------------------------------------------------------------------------------------------


def brute_runs(x, powers=R.POWERS, least=R.LEAST):
    n, out = len(x), []
    for q in range(1, n // powers + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and x[i] == x[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(least, powers * q) and not any(p < q and a <= s and a + b >= s + size for a, b, p in out):
                out.append((s, size, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(ws, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return b" ".join(w for i, w in enumerate(ws) if i not in gone)


_pieces = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=4), st.integers(1, 7)), max_size=12)


@settings(max_examples=400, deadline=None)
@given(_pieces, st.sampled_from([(4, 6), (2, 2), (3, 1)]))
def test_runs_of_any_sequence(pieces, limits):
    x = [v for part, times in pieces for v in part * times]
    assert [tuple(r) for r in R.runs_of(x, *limits).tolist()] == brute_runs(x, *limits)


@settings(max_examples=200, deadline=None)
@given(st.lists(_pieces, min_size=1, max_size=4))
def test_stretches_hold_every_run(docs):
    texts = [" ".join(f"w{v}" for part, times in d for v in part * times).encode() for d in docs]
    for text, (n, found, kept) in zip(texts, R._documents(texts, R.POWERS, R.LEAST), strict=True):
        want = brute_runs(text.split())
        assert n == len(text.split()) and [tuple(r) for r in found] == want and kept == collapse(text.split(), want)


def test_lce_of_the_tree():
    rng = random.Random(5)
    for _ in range(50):
        x = [rng.randrange(2) for _ in range(rng.randint(2, 40))]
        tree = R.SuffixTree(x)
        i, j = (np.array(v) for v in zip(*[(a, b) for a in range(len(x)) for b in range(len(x)) if a != b]))
        want = [next((k for k in range(len(x)) if max(a, b) + k >= len(x) or x[a + k] != x[b + k])) for a, b in zip(i, j)]
        assert tree.lce(i, j).tolist() == want


def test_runs_of_awkward_documents(spark):
    data = awkward() + rows(["a b " * 3000 + "c", "x y z " * 2 + "x", "k " * 6, "k " * 5])
    got = R.periodic_runs(frame(spark, data)).select("row.doc_id", "row.row", "n_words", "runs", "top", "kept").collect()
    assert len(got) == len(data)
    want = []
    for d in data:
        ws = (d[1] or "").encode().split()
        found = brute_runs(ws) if len(ws) < 9000 else []
        want.append((d[0], len(ws), found, collapse(ws, found)))
    mine = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.kept)) for r in got]
    key = lambda r: (r[0] is None, r[0] or 0, r[3])
    assert sorted(mine, key=key) == sorted(want, key=key)
    assert R.periodic_runs(frame(spark, [])).count() == 0


def test_top_run_is_the_greatest_exact_exponent(spark):
    text = "p q " * 4 + "l " + "a b c " * 5 + "m " + "d " * 6 + "n " + "e " * 6
    top = R.periodic_runs(frame(spark, rows([text]))).first().top
    assert (top.start, top.length, top.period) == (25, 6, 1)


# --- personal data -----------------------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            if (kind == "email" or kind == "ip" and max(map(int, m.group().split("."))) <= 255
                    or kind == "card" and 14 <= len(digits) <= 19 and total % 10 == 0 or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="aB1234567890..--  @@++()_%é\n", max_size=80))
def test_strict_spans_are_the_patterns(text):
    assert D.base_spans(text) == brute_spans(text)


def test_strict_spans_of_edges():
    for text in ("1.2.3.4.5.6.7.8", "a@b.c@d.e", "x@a.b..c", "256.1.1.1", "007.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 9",
                 "+1 (017) 555-7713.", "++49 30 1234567-", "é.x@y.z", "\U0001F600 1.2.3.4"):
        assert D.base_spans(text) == brute_spans(text), text


def test_scanning_is_linear():
    for text in ("x" * 300000, "1" * 300000, "1 " * 150000, "a@" * 150000, "1." * 150000, "1:" * 150000, " at " * 80000, "+1" + " " * 300000):
        D.candidates_of(text)


def cases(n=240):
    """Documents with strict data, with loose data, with look-alikes, and clean ones."""
    rng = random.Random(11)
    num = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    texts, loose, clean = [], [], []
    for i in range(n):
        lead, tail = words(i, 30) + " ", " " + words(i + 9000, 30)
        kind = i % 6
        if kind == 0:
            data = f"write to {words(i, 1)}.{num(2)}@mail{num(1)}.example.com or call +1 ({num(3)}) 555-{num(4)}"
        elif kind == 1:
            card = next(c for c in iter(lambda: "4" + num(15), None) if D.luhn(c))
            data = f"card {card} from {rng.randint(1, 250)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(1, 255)}"
        elif kind == 2:
            data = rng.choice([f"phone ({num(3)}) 555-{num(4)}", f"call {num(3)}-555-{num(4)}"])
            loose.append(i)
        elif kind == 3:
            card = next(c for c in iter(lambda: "4" + num(15), None) if not D.luhn(c))
            data = f"order {card}, section {num(7)}, version 4.{num(1)}"
        elif kind == 4:
            data = f'token = "a{num(9)}b{num(12)}c" sku {num(10)}x build{num(8)}'
        else:
            data = words(i + 500, 12)
        if kind >= 3:
            clean.append(i)
        texts.append(lead + data + tail)
    return texts, loose, clean


def test_spans_are_found_and_clean_texts_left_alone(spark):
    texts, loose, clean = cases()
    got = {r.doc_id: r.spans for r in D.personal_data(frame(spark, rows(texts))).select("row.doc_id", "spans").collect()}
    for i, t in enumerate(texts):
        assert [(s.start, s.end, D.KINDS.index(s.kind)) for s in got[i] if s.strict] == brute_spans(t)
    assert np.mean([any(s.kind == "phone" for s in got[i]) for i in loose]) >= 0.9
    assert np.mean([not got[i] for i in clean]) >= 0.98


def test_like_one_process(spark):
    """The distributed run is the same as all steps over one list."""
    texts, _, _ = cases(120)
    found = [D.candidates_of(t) for t in texts]
    counts = {}
    for c in (c for cs in found for c in cs):
        counts[c[0], c[4]] = counts.get((c[0], c[4]), 0) + 1
    soft = {}
    for kind in range(4):
        table = np.array(sorted((p, n) for (k, p), n in counts.items() if k == kind)).reshape(-1, 2)
        if len(table):
            soft |= {(kind, p): v for p, v in zip(table[:, 0].tolist(), D.reliabilities(table)[0].tolist())}
    flat = [c for cs in found for c in cs]
    weights = D.train(np.array([c[5] for c in flat]), np.array([soft[c[0], c[4]] for c in flat]))
    want = {i: {(c[1], c[2], D.KINDS[c[0]]) for c in cs if c[3] or weights[c[5]].sum() > 0} for i, cs in enumerate(found)}
    rows_ = D.personal_data(frame(spark, rows(texts))).select("row.doc_id", "spans").collect()
    got = {r.doc_id: {(s.start, s.end, s.kind) for s in r.spans} for r in rows_}
    for i in want:  # of added spans that overlap, one stays
        assert got[i] <= want[i] and {s[0] for s in got[i]} == {s[0] for s in want[i]}


def test_em_rates_labelers():
    rng = np.random.default_rng(2)
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6, 0.55, 0.5])
    truth = rng.random(4000) < 0.3
    votes = np.where(rng.random((4000, 7)) < right, truth[:, None], ~truth[:, None]) * 2
    pattern, n = np.unique(votes @ 3 ** np.arange(7), return_counts=True)
    posterior, table, prior = D.reliabilities(np.stack([pattern, n], axis=1))
    assert abs(prior - 0.3) < 0.05 and np.all(np.diff(table[1, :, 2]) < 0.05)
    by_row = dict(zip(pattern.tolist(), posterior))
    assert np.mean([(by_row[p] > 0.5) == t for p, t in zip((votes @ 3 ** np.arange(7)).tolist(), truth)]) > 0.93


def test_registered_query_digests(spark):
    """The query's columns from the strict spans, over a whole table."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op12_personal_data"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        want = brute_spans(texts[r.doc_id] or "")
        listed = ",".join(f"{D.KINDS[k]}:{s}:{e}" for s, e, k in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, _, k in want) for n in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_personal_data_of_awkward_documents(spark):
    data = awkward() + rows(["a@b.co " * 2000, "1.2.3.4"])
    got = D.personal_data(frame(spark, data))
    assert got.count() == len(data) and got.where(F.size("spans") > 0).count() == 2
    assert D.personal_data(frame(spark, [])).count() == 0
    assert set(got.select("row.*").columns) == {f.name for f in SCHEMA} - {"text"}


# --- hard negatives ----------------------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 2**32), st.integers(0, 600), st.sampled_from([1, 5, 130, 40000, 2**28]))
def test_products_are_exact(seed, width, limit):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-limit, limit + 1, (3, width)) for _ in "ab")
    primes = H.primes_for(max(1, width * limit * limit))
    got = H.products(H.residues(a.astype(float), primes), H.residues(b.astype(float), primes), primes)
    assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist() if width else not got.any()


VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("label", T.IntegerType()),
    T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("key", T.StringType()), T.StructField("cell", T.StringType()),
])


def brute_negatives(data, positives=5, negatives=10):
    usable = [(i, y, v) for i, y, v, *_ in data
              if None not in (i, y, v) and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b))
    out = []
    for a, y, v in usable:
        if a % 10:
            continue
        scored = sorted((-dot(v, w), i, z) for i, z, w in usable if i != a)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            fits = [x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, k + 1, x[1], -s, -x[0]) for k, x in enumerate(fits)]
    return sorted(out)


@pytest.mark.parametrize("seed, spread", [(0, 3), (1, 130), (2, 2**20)])
def test_hard_negatives_like_brute_force(spark, monkeypatch, seed, spread):
    monkeypatch.setattr(H, "GROUP", 7)
    rng = random.Random(seed)
    data = [(i, rng.randrange(3), [float(rng.randint(-spread, spread)) for _ in range(rng.choice([6, 6, 5]))], "k", "c") for i in range(120)]
    data += [(200, 1, None, "k", "c"), (210, None, [1.0] * 6, "k", "c"), (None, 1, [1.0] * 6, "k", "c"), (220, 1, [1.0, None], "k", "c"),
             (230, 2, [float("nan")], "k", "c"), (240, 2, [float("inf")] * 6, "k", "c"), (250, 2, [], "k", "c")]
    data += [data[13], data[20], data[20]]  # repeated rows, two of them anchors
    got = H.hard_negatives(spark.createDataFrame(data, VECTORS).repartition(3), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(data)


def test_hard_negatives_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert H.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0
    one = spark.createDataFrame([(10, 1, [1.0], "k", "c")], VECTORS)
    assert H.hard_negatives(one, F.col("vec_id") % 10 == 0).count() == 0
    assert H.hard_negatives(one, F.col("vec_id") % 10 == 1).count() == 0


def test_scores_beyond_a_long_are_an_error(spark):
    big = spark.createDataFrame([(10, 1, [1e18] * 3, "k", "c"), (11, 1, [1e18] * 3, "k", "c")], VECTORS)
    with pytest.raises(ValueError, match="do not fit a long"):
        H.hard_negatives(big, F.col("vec_id") % 10 == 0)
