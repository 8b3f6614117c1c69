"""Substring and suffix dedup against brute force."""

import collections
import hashlib
import re

import numpy as np
import pytest

from eventlake.llm import sketch
from eventlake.llm import substring_dedup as substring_dedup_module
from eventlake.llm import suffix_dedup as suffix_dedup_module
from eventlake.llm.spans import keyed
from eventlake.llm.substring_dedup import substring_dedup
from eventlake.llm.suffix_dedup import deep_shallow_sort, suffix_dedup

from .helpers import awkward, frame, rows, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(data, window):
    lists = [WORD.findall(r[1] or "") for r in data]
    count = collections.Counter(tuple(w[p : p + window]) for w in lists for p in range(len(w) - window + 1))
    out = []
    for r, w in zip(data, lists, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if count[tuple(w[p : p + window])] > 1:
                gone |= set(range(p, p + window))
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def brute_bytes(data, width):
    order = lambda i: float("inf") if i is None else i
    texts = [(r[0], (r[1] or "").encode()) for r in data]
    least = {}
    for i, t in texts:
        for p in range(len(t) - width + 1):
            s = t[p : p + width]
            least[s] = min(least.get(s, float("inf")), order(i))
    out = []
    for i, t in texts:
        gone = set()
        for p in range(len(t) - width + 1):
            if least[t[p : p + width]] < order(i):
                gone |= set(range(p, p + width))
        spans = sum(1 for x in gone if x - 1 not in gone)
        out.append((i, len(t), len(gone), spans, hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in gone)).hexdigest()))
    return sorted(out, key=str)


def words_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in df.collect()), key=str)


def bytes_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=str)


@pytest.mark.parametrize("window", [35, 8])
def test_words_like_brute_force(spark, window):
    data = awkward()
    got = substring_dedup(frame(spark, data), window=window, gram=min(8, window))
    assert words_of(got) == brute_words(data, window)


def test_words_full_sketch_loses_nothing(spark):
    """A sketch with hardly any cells overestimates everything; the result is the same."""
    data = awkward()
    assert words_of(substring_dedup(frame(spark, data), bits=16, depth=1)) == brute_words(data, 35)


def test_periodic_text_and_hot_passage(spark):
    passage = words(50, 40)
    data = rows([passage + " " + words(100 + i, 20 + i % 30) for i in range(60)] + ["p q r " * 40, "p q " * 30 + words(99, 10)])
    assert words_of(substring_dedup(frame(spark, data, 7))) == brute_words(data, 35)
    assert bytes_of(suffix_dedup(frame(spark, data, 7), bits=20)) == brute_bytes(data, 50)


def test_bytes_like_brute_force(spark):
    data = awkward()
    assert bytes_of(suffix_dedup(frame(spark, data), bits=20)) == brute_bytes(data, 50)
    assert bytes_of(suffix_dedup(frame(spark, data), bits=16)) == brute_bytes(data, 50)


def test_empty_tables(spark):
    assert substring_dedup(frame(spark, [])).collect() == []
    assert suffix_dedup(frame(spark, []), bits=20).collect() == []


def test_very_long_text_in_slices(spark, monkeypatch):
    from eventlake.llm import common, suffix_dedup as module

    data = rows([words(1, 3000) + " " + words(2, 100), words(2, 100) + " " + words(3, 50)])
    monkeypatch.setattr(module, "CHUNK", 512)
    monkeypatch.setattr(common, "PIECE", 512)
    assert brute_words(data, 35) == words_of(substring_dedup(frame(spark, data, 1)))
    assert brute_bytes(data, 50) == bytes_of(suffix_dedup(frame(spark, data, 1), bits=20))


def test_deep_shallow_order():
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 99, 4000).astype(np.uint8)
    raw[1000:1400] = raw[200:600]
    raw[2000:2300] = 97
    padded = np.concatenate([raw, np.zeros(16, np.uint8)])
    starts = np.arange(len(raw) - 50 + 1)
    order, new = deep_shallow_sort(padded, starts, 50)
    strings = [raw[s : s + 50].tobytes() for s in starts[order]]
    assert strings == sorted(strings)
    assert new.tolist() == [True, *(a != b for a, b in zip(strings, strings[1:], strict=False))]


def test_hashing_in_pieces():
    import pyarrow as pa

    from eventlake.llm import common

    text = pa.array([words(1, 500), None, "", "x" * 5000, "é " * 300, words(1, 500)])
    raw, offsets = common.buffers(text)
    whole, first = common.word_hashes(raw, offsets)
    assert np.diff(first).tolist() == [len(WORD.findall(t or "")) for t in text.to_pylist()]
    assert (whole[: first[1]] == whole[first[5] :]).all()
    old = common.PIECE
    try:
        common.PIECE = 100
        again, first_again = common.word_hashes(raw, offsets)
    finally:
        common.PIECE = old
    assert (first == first_again).all() and (whole == again).all()


@pytest.mark.parametrize("kind", ["words", "bytes"])
def test_hot_mark_is_spread_over_buckets(spark, kind):
    """A stock phrase with other surroundings in every text: results as by brute force, and no bucket holds most windows."""
    phrase = words(3, 9)
    data = rows([f"{words(10 + i, 30)} {phrase} {words(900 + i, 30)}" for i in range(120)] + [words(11, 30) + " " + phrase + " " + words(901, 30)])
    df = frame(spark, data)
    texts = df.select("text")
    if kind == "words":
        assert words_of(substring_dedup(df, hot_rate=1.0)) == brute_words(data, 35)
        run, marks = substring_dedup_module._suspects, substring_dedup_module._marks(35, 8)
        settings, held = (35, 8, 20, 64), lambda r: len(r.at) // 4
    else:
        assert bytes_of(suffix_dedup(df, hot_rate=1.0)) == brute_bytes(data, 50)
        run, marks = suffix_dedup_module._segments, suffix_dedup_module._marks(50, 24)
        settings, held = (50, 24, 20, 64), lambda r: r.n
    every, hot = (spark.sparkContext.broadcast(x) for x in (sketch.build(texts, marks, 20, 1), sketch.hot(texts, marks, 1.0)))
    schema = substring_dedup_module.ROUTED if kind == "words" else suffix_dedup_module.ROUTED
    size = collections.Counter()
    for r in keyed(df, "doc_id", "text").mapInArrow(run(every, hot, *settings), schema).collect():
        size[r.bucket] += held(r)
    assert max(size.values()) < 0.2 * sum(size.values())


@pytest.mark.parametrize("cells", [16, 1e-3])
def test_sharded_sketch_like_brute_force(spark, monkeypatch, cells):
    """No broadcast: the sketch is sharded by its cells and its verdicts go to the documents; also with cells far too few."""
    data = awkward() + rows([words(50, 40) + " " + words(300 + i, 20) for i in range(40)], ids=list(range(100, 140)))
    monkeypatch.setattr(sketch, "CELLS", cells)
    assert words_of(substring_dedup(frame(spark, data, 5), load=0)) == brute_words(data, 35)
    assert bytes_of(suffix_dedup(frame(spark, data, 5), load=0)) == brute_bytes(data, 50)
    assert substring_dedup(frame(spark, []), load=0).collect() == []
    assert suffix_dedup(frame(spark, []), load=0).collect() == []


def test_verdicts_are_few_and_complete(spark):
    """Marks that occur twice are all found, and hardly any other, as the cells grow with the marks."""
    data = rows([words(i, 400) for i in range(300)] + [words(7, 400)], ids=list(range(301)))
    df = keyed(frame(spark, data, 6), "doc_id", "text")
    windows = lambda text: substring_dedup_module._windows(text, 35, 8)
    n = 300 * 400 // 14
    judged = sketch.verdicts(df, windows, n)
    held = {r.doc: sum(r["size"]) for r in judged.select("doc", "at", "size").collect()}
    assert held[7] == held[300] >= 20  # the text that stands twice
    assert sum(held.values()) - held[7] - held[300] < 0.2 * n
