"""Labelled answers, objects in prose, JSON in JSON, vectors as text, flattened settings."""

import json

import pytest
from pyspark.sql import functions as F

from newsloom.functions import model_output as M


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("o")).first().o


@pytest.mark.parametrize("text, want", [
    ("摘要：甲。\n分析：乙\n重要性：高，因為\n重要性原因：丙\n標籤：a、b, c，\n地區：台北", ("甲。", "乙", "高", "丙", ["a", "b", "c"], "台北")),
    ("摘要：\n一\n二\n分析：三\n四\n\n五\n重要性：？", ("一二", "三", "中", "", [], "")),
    ("分析：\n一\n二\n重要性：低", ("分析：\n一\n二\n重要性：低", "一二", "低", "", [], "")),
    ("free text " * 40, (("free text " * 40)[:300], "", "中", "", [], "")),
    ("  摘要： x \r\n重要性：高\n重要性：壞", ("x", "", "高", "", [], "")),
    ("", ("", "", "中", "", [], "")), (None, ("", "", "中", "", [], "")),
])
def test_answer_fields(spark, text, want):
    assert tuple(one(spark, M.answer_fields, text)) == want


@pytest.mark.parametrize("text, want", [
    ('say {"a": {"b": 1}} and {x}', '{"a": {"b": 1}}'), ("none", None), ("{ open { }", None), ("} {}", "{}"), ("", None), (None, None), ("é{}😀", "{}"),
])
def test_outermost_object(spark, text, want):
    assert one(spark, M.outermost_object, text) == want


def test_excluded_candidates(spark):
    assert one(spark, M.excluded, 'ok: {"exclude": ["N1", 3, "N2", null], "reasons": {"N1": "x"}} done') == ["N1", "N2"]
    for bad in ("no json", '{"exclude": "N1"}', "{]}", None, '{"other": 1}'):
        assert one(spark, M.excluded, bad) == []
    c = spark.createDataFrame([("g", 1, "a"), ("g", 2, "b"), ("g", 3, "c"), ("h", 1, "d"), ("k", 1, "e")], "g string, i int, t string")
    a = spark.createDataFrame([("g", '{"exclude": ["N2", "N9"]}'), ("h", "nothing")], "g string, text string")
    assert sorted(r.t for r in M.kept_candidates(c, a, "g", "i").collect()) == ["a", "c", "d", "e"]


@pytest.mark.parametrize("text, want", [("[1.0,0.5]", [1.0, 0.5]), (" [1, -2e-3]\n", [1.0, -0.002]), ("[1,x]", None), ("", None), (None, None), ("[]", None)])
def test_vectors_as_text(spark, text, want):
    assert one(spark, M.vector_of_text, text) == want


def _line(url):
    return json.dumps([["wrb.fr", M.CALL, json.dumps(["garturlres", url])]])


@pytest.mark.parametrize("text, want", [
    (")]}'\n\n123\n" + _line("https://udn.com/news/1/2"), "https://udn.com/news/1/2"), (_line(f"https://{M.AGGREGATOR}/articles/x"), None), (_line("intent://foo"), None),
    (M.CALL + " not-json", None), (")]}'\n\nno match here", None), (_line("intent://foo") + "\n" + _line("http://a/b"), "http://a/b"), (M.CALL + " bad\n" + _line("http://a/b"), None), (None, None),
])
def test_resolved_url(spark, text, want):
    assert one(spark, M.resolved_url, text) == want


def test_flattened_settings_and_their_drift(spark):
    a = {"x": 1, "y": {"z": [1, {"w": "s"}], "n": None, "e": {}}, "t": True, "k": "1", "gone": [0]}
    b = {"x": "1", "y": {"z": [1, {"w": "t"}, 5], "n": None}, "t": True, "k": "1"}

    def flat(o, at=""):
        if isinstance(o, dict):
            for k, v in o.items():
                yield from flat(v, f"{at}.{k}" if at else k)
        elif isinstance(o, list):
            for i, v in enumerate(o):
                yield from flat(v, f"{at}[{i}]")
        else:
            yield at or "<root>", o

    rows = lambda *objects: spark.createDataFrame([(i, json.dumps(o) if isinstance(o, (dict, int)) else o) for i, o in enumerate(objects)], "id int, j string")
    before, after = M.flatten_json(rows(a, 7, "{bad", None), "id", "j"), M.flatten_json(rows(b, 7), "id", "j")
    assert {(r.id, r.path) for r in before.collect()} == {(0, p) for p, _ in flat(a)} | {(1, "<root>")}
    got = {(r.id, r.path): r.drift for r in M.drift(before, after, ["id", "path"]).collect()}
    fa, fb = dict(flat(a)), dict(flat(b))
    want = {(0, p): "missing" if p not in fb else "added" if p not in fa else "same" if (fa[p], type(fa[p])) == (fb[p], type(fb[p])) else "changed" for p in fa | fb}
    assert got == want | {(1, "<root>"): "same"}
    assert M.flatten_json(rows(a).where("false"), "id", "j").count() == 0
