"""Array files read by ranges: the same rows as reading each file as one document."""

import json
import os
import random

import pytest

from eventlake.operators import parse as P
from eventlake.sources import arrays as A
from eventlake.sources import files as SRC


def _events(n, rng):
    tricky = ["a,b", 'q"x', "\\", "[}", "é,ü", '\\"', ",", "\\\\", "{", " ", "x" * 50]
    return [{"event_id": i, "s": rng.choice(tricky), "n": [1, {"k": [i, i]}], "f": 1.5} for i in range(n)]


def _texts():
    rng = random.Random(4)
    return {
        "one_line": json.dumps(_events(60, rng)), "indented": json.dumps(_events(40, rng), indent=2),
        "raw_unicode": json.dumps(_events(50, rng), ensure_ascii=False), "cut_off": json.dumps(_events(12, rng))[:-40],
        "empty": "[]", "blank_array": " [ ] \n", "object": json.dumps(_events(1, rng)[0]), "kinds": '[1,2,"x",null,[1,2],{}]',
        "hole": "[1,,2]", "comma_after": "[1,2],", "text_after": "[1,2] x", "comma_before": ",[1]", "closed_twice": "[1,2]]",
        "crossed": '[{"a":1]}', "number": "17", "two_roots": "1,2", "text": '"a,b"', "no_comma": "[1 2]",
        "nan": '[{"a":NaN,"b":"x,y"},{"b":2}]', "nothing": "", "comma_last": "[1,]", "comma_first": "[,1]",
        "deep_object": '{"a":[1,2,3],"b":{"c":"d,]"}}', "nested": '[["a,b"],["\\\\","c"]]', "spaced": '[ "a" , "b" ]', "newlines": "[1,2]\n\n",
        "wrong_close": "[1}", "open_string": '["a,b', "escaped_comma": '["a\\,b"]', "bom": "﻿[1,2]",
    }


@pytest.mark.parametrize("split", [7, 1000, 1 << 20])
def test_ranges_like_documents(spark, tmp_path, split):
    texts = {n: t for n, t in _texts().items() if split > 100 or len(t) < 100}  # a task for every few bytes
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    key = lambda r: (os.path.basename(r.path), r.pos, r.value)
    want = sorted(key(r) for r in SRC.explode_documents(SRC.read_documents(spark, str(tmp_path))).collect() if "bom" not in r.path)
    got = sorted(key(r) for r in A.scan_arrays(spark, [str(tmp_path / f"{n}.json") for n in texts if texts[n]], split).collect())
    want = [r for r in want if r[0] != "nothing.json"]  # an empty file is never a large one
    assert [r for r in got if r[0] != "bom.json"] == want
    assert [r[2] for r in got if r[0] == "bom.json"] == ["1", "2"]
    if split > 100:
        both = A.read_arrays(spark, str(tmp_path), whole_bytes=600, split_bytes=split)
        assert sorted(key(r) for r in both.collect() if "bom" not in r.path and "nothing" not in r.path) == want


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    rng = random.Random(1)
    events = [{"event_id": i, "event_type": "view", "customer_id": 1, "product_id": 2, "session_id": rng.choice(["a,b", "]"])} for i in range(2000)]
    (tmp_path / "big.json").write_text(json.dumps(events))
    size = (tmp_path / "big.json").stat().st_size
    rows = A.scan_arrays(spark, [str(tmp_path / "big.json")], split_bytes=size // 12)
    stored = [r for r in P.valid_rows(P.parse(rows.select("value"))).collect()]
    assert sorted(r.event_id for r in stored) == list(range(2000))
    assert sorted(r.pos for r in rows.select("pos").collect()) == list(range(2000))
    with A._split_size(spark, size // 12):
        assert spark.read.option("lineSep", ",").text(str(tmp_path / "big.json")).rdd.getNumPartitions() >= 12


def test_long_document_cut_off_dead_letters_once(spark, tmp_path):
    text = json.dumps([{"event_id": i, "event_type": "view"} for i in range(2000)])
    (tmp_path / "cut.json").write_text(text[:-1])
    rows = A.scan_arrays(spark, [str(tmp_path / "cut.json")], split_bytes=4096)
    (row,) = rows.collect()
    assert row.pos == 0 and row.value == text[: A.KEPT_OF_BAD] + "…"
    (dead,) = P.deadletter_rows(P.parse(rows.select("value"))).collect()
    assert dead.error == "INVALID_JSON" and dead.raw_message == text[:500]


def test_text_after_the_value_is_no_json(spark):
    docs = spark.createDataFrame([("[1] 2",), ("[1],",), ('{"a":NaN}]',), ("[1]",)], "value string")
    assert sorted(r.value for r in SRC.explode_documents(docs).collect()) == ["1", "[1] 2", "[1],", '{"a":NaN}]']
