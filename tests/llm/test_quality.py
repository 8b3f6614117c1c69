"""Language ID, line quality and URL filters."""

import collections
import datetime as dt
import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from eventlake.llm import language_id, url_filter
from eventlake.llm.line_quality import line_quality

from .helpers import awkward, frame, rows, words

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    part = F.crc32(F.col("doc_id").cast("string")) % 3
    model = language_id.fit(docs.filter(part != 1))
    assert len(set(model.languages)) == 4 and len(model.languages) > 4  # several centroids per language
    out = language_id.predict(docs.filter(part == 1), model).select("row.*", "lang_pred", "score", "rejected").collect()
    long = [r for r in out if len(r.text) > 200]
    assert sum(r.lang_pred == r.lang for r in long) / len(long) > 0.98
    assert all(0 <= r.score <= 1 for r in out)
    assert sum(r.rejected for r in out) <= 0.005 * len(out)


def test_language_rejects_by_distance_and_defined_cases(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, per_language=50)
    texts = [None, "", "123 456 !!", "これは日本語の文章です。" * 20, "Это русский текст без латиницы. " * 10, "é"]
    got = {r.row.doc_id: r for r in language_id.predict(frame(spark, rows(texts)), model).collect()}
    for i in (0, 1, 2):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[3].rejected and got[4].rejected and not got[5].rejected
    assert got[5].lang_pred in model.languages
    same = [r for r in language_id.predict(frame(spark, awkward()), model).collect() if r.row.doc_id == 6]
    assert len(same) == 2 and same[0].score == same[1].score
    again = language_id.fit(docs, per_language=50)
    assert (again.centroids == model.centroids).all()


def test_language_nothing_to_learn(spark):
    model = language_id.fit(frame(spark, []))
    got = {r.row.doc_id: r for r in language_id.predict(frame(spark, rows(["abc", "12"])), model).collect()}
    assert (got[0].lang_pred, got[0].rejected, got[1].rejected) == ("und", False, True)
    assert language_id.predict(frame(spark, []), model).collect() == []


def test_ngram_counts_over_pieces():
    import numpy as np

    raw = np.frombuffer((words(1, 300_000)).encode(), np.uint8)
    assert len(raw) > 1 << 20
    whole, _ = language_id._counts(raw, 512)
    assert whole.sum() >= 2 * len(raw) - 10  # every 2- and 3-gram counted, those at piece borders too


def brute_quality(data, min_docs, share, least_left):
    norm = lambda line: re.sub("[1-9]", "0", " ".join(WORD.findall(line.lower())))
    docs = {}
    for r in data:
        docs.setdefault((r[0], r[1], r[3]), r)
    held, hosts = collections.Counter(), collections.Counter()
    for i, t, s in docs:
        hosts[s] += 1
        for k in {norm(x) for x in (t or "").split("\n") if WORD.search(x)}:
            held[s, k] += 1
    out = []
    for r in data:
        t = r[1] or ""
        w = WORD.findall(t)
        grams = collections.Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        rep = {p + k for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        gone = sum(len(WORD.findall(x)) for x in lines if held[r[3], norm(x)] > min_docs and held[r[3], norm(x)] > hosts[r[3]] * share)
        failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
        depleted = len(w) - gone < least_left * len(w)
        out.append((r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(rep), failed, gone, depleted, not failed and not depleted))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_docs", [1, 20])
def test_lines_like_brute_force(spark, min_docs):
    common = words(5, 12)
    data = awkward() + rows(
        [common.upper() + "\n" + words(200 + i, 60 if i % 3 else 4) + f"\n# page {i}" for i in range(40)],
        sources=["h", "i"] * 20, ids=list(range(100, 140)),
    )
    got = line_quality(frame(spark, data), min_docs=min_docs, share=0.1).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_quality(data, min_docs, 0.1, 0.3)


def test_lines_empty(spark):
    assert line_quality(frame(spark, [])).collect() == []


@pytest.mark.parametrize(
    "url, key",
    [
        ("HTTP://User@Www.Example.COM:80/A/b/?q=1#f", "www.example.com/A/b"),
        ("example.org", "example.org"), ("https://x.y.z/", "x.y.z"), ("  //", ""), ("", ""),
    ],
)
def test_canonical(spark, url, key):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(url_filter.canonical("url").alias("c")).first().c.lstrip("/") == key


def test_url_filter_like_brute_force(spark):
    rng = random.Random(4)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    hosts = ["a.hot.com"] * 6 + ["b.hot.com", "c.org", "d.e.net"]
    captures = [(i, f"http://{rng.choice(hosts)}/p{rng.randint(0, 5)}", day(rng.randint(0, 99))) for i in range(400)]
    captures += [(400, None, day(3)), (401, "http://a.hot.com/p1", None), (402, "http://a.hot.com/p1", day(5)), (402, "http://a.hot.com/p1", day(5)), (403, "", day(4))]
    keys = ["hot.com", "a.hot.com", "a.hot.com/p1", "c.org", "e.net", "d.e.net/p2"]
    entries = [(rng.choice(["block", "allow", "block"]), rng.choice(keys), rng.choice(["add", "remove"]), day(rng.randint(0, 120)), i) for i in range(80)]
    entries += [("block", "c.org", "add", day(10), 5000), ("block", "c.org", "remove", day(10), 5000), (None, "c.org", "add", day(1), 1), ("block", "c.org", "add", None, 1), ("block", "e.net", None, day(1), 1)]

    def active(key, at):
        found = set()
        for name in ("block", "allow"):
            past = [(e[3], e[4], e[2] != "add") for e in entries if e[0] == name and e[1] == key and e[2] and e[3] and e[3] <= at]
            if past and not max(past)[2]:
                found.add(name)
        return found

    want = []
    for i, url, at in captures:
        hits = []
        if url and at:
            host = url.split("/")[2]
            labels = host.split(".")
            ks = {url.split("//")[1], host, *(".".join(labels[k:]) for k in range(len(labels) - 1))}
            hits = [x for k in ks for x in active(k, at)]
        b, a = hits.count("block"), hits.count("allow")
        want.append((i, url, at, b, a, b > 0 and a == 0))
    c = spark.createDataFrame(captures, "page_id long, url string, day date")
    e = spark.createDataFrame(entries, "list string, key string, action string, day date, seq long")
    got = [tuple(r) for r in url_filter.evaluate(c, e).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    empty = url_filter.evaluate(c, e.limit(0)).collect()
    assert len(empty) == len(captures) and not any(r.blocked for r in empty)
    assert url_filter.evaluate(c.limit(0), e).collect() == []
    clash = url_filter.evaluate(c.withColumn("key", F.lit("z")).withColumn("blocked", F.lit("?")), e)
    assert clash.columns == ["page_id", "url", "day", "key", "n_block", "n_allow", "blocked"]


def test_intervals(spark):
    day = lambda n: dt.date(2024, 1, n)
    e = [("block", "k", a, day(d), d) for a, d in (("add", 2), ("add", 4), ("remove", 7), ("add", 9))]
    got = url_filter.intervals(spark.createDataFrame(e, "list string, key string, action string, day date, seq long")).orderBy("valid_from").collect()
    assert [(r.valid_from.day, r.valid_to) for r in got] == [(2, day(4)), (4, day(7)), (9, dt.date(9999, 12, 31))]


def test_noise_is_rejected_and_clean_text_kept(spark):
    """Random letters, consonants and base64 lines are far from every language; held-out texts are not."""
    rng = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language_id.fit(docs.filter(~held_out))
    some = lambda letters, n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))
    noise = [some("abcdefghijklmnopqrstuvwxyz", n) for n in (50, 300, 300, 1000)] + [some("bcdfghjklmnpqrstvwxz", 300) for _ in range(4)]
    noise += ["\n".join(base64.b64encode(rng.randbytes(57)).decode() for _ in range(n)) for n in (5, 20, 50, 100)]
    got = language_id.predict(spark.createDataFrame(list(enumerate(noise)), "doc_id long, text string"), model)
    assert got.filter("rejected").count() == len(noise)
    kept = language_id.predict(docs.filter(held_out).select("doc_id", "text"), model).filter("NOT rejected").count()
    assert kept >= 0.995 * docs.filter(held_out).count()
