"""Expressions against plain Python, on hand-written rows and generated ones."""

import hashlib
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memoloom.functions import text
from memoloom.functions.identity import memo_id, normalize_memo
from memoloom.functions.numbers import dot, ratio, unit

EDGE = ["Great TV!!", "great   tv", "GREAT-TV", "great　tv", "\tgreat\ntv", None, "...", "", "Héllo wörld", "ㅋㅋ 좋아요"]


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(F.expr(expr("x")).alias("y")).first()["y"]


def test_equal_content_has_one_identity(spark):
    df = spark.createDataFrame([(i, "a", "b", 1, m) for i, m in enumerate(EDGE)], "i int, cate_1_depth string, cate_2_depth string, sc_measurement int, memo string")
    got = {r["i"]: (r["n"], r["id"]) for r in df.withColumn("n", normalize_memo("memo")).select("i", "n", memo_id("n").alias("id")).collect()}
    assert len({got[i] for i in range(5)}) == 1 and got[0][0] == "great tv"
    assert got[0][1] == hashlib.sha256(b"a||b||1||great tv").hexdigest()
    assert got[5][0] == got[6][0] == got[7][0] == ""
    assert got[8][0] == "h llo w rld" and got[9][0] == "좋아요"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB c-\t.,가", max_size=12), min_size=1, max_size=6))
def test_phrases_and_tokens(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = df.select("x", F.expr(text.tokens("x")).alias("t"), F.expr(text.phrase("x")).alias("p")).collect()
    for r in got:
        assert r["t"] == list(dict.fromkeys(r["x"].lower().split()))
        assert r["p"] == " ".join(re.sub(r"[^\w가-힣]+", " ", r["x"].lower()).split())


def remove(x, terms):
    for t in sorted(terms, key=len, reverse=True):
        x = " ".join(re.sub(rf"(?<!\w){re.escape(t)}(?!\w)", " ", x).split())
    return x


@pytest.mark.parametrize("x,terms", [("great remote control app", ["remote", "remote control"]), ("good good tv", ["good"]), ("tv", []), ("c++ is good", ["c"]), ("best tvs", ["tv"])])
def test_remove_phrases(spark, x, terms):
    arr = "cast(array(" + ", ".join(f"'{t}'" for t in terms) + ") as array<string>)"
    base = " ".join(re.sub(r"[^\w가-힣]+", " ", x).split())
    assert one(spark, x, lambda c: text.remove_phrases(c, arr)) == remove(base, terms)


def near(x, targets, reasons, gap, reach=40):
    low, toks = " ".join(x.lower().split()), x.lower().split()
    for a in targets:
        for b in reasons:
            if a in low and b in low and abs(low.index(a) - low.index(b)) <= reach:
                return True
    hit = lambda terms: [i for i, w in enumerate(toks) for t in terms if t in w or w in t.split()]
    return any(abs(i - j) <= gap for i in hit(targets) for j in hit(reasons))


@pytest.mark.parametrize("pad", [0, 30, 34, 35, 36, 60])
@pytest.mark.parametrize("gap", [1, 4])
def test_attached(spark, pad, gap):
    x = "tv " + "y" * pad + " is slow"
    want = near(x, ["tv"], ["slow"], gap)
    assert one(spark, x, lambda c: text.attached(c, "array('tv')", "array('slow')", gap)) == want
    assert one(spark, x, lambda c: text.attached(c, "array('radio')", "array('slow')", gap)) is False


def test_lists(spark):
    assert one(spark, '["a","b"]', text.json_list) == ["a", "b"]
    assert one(spark, "not json", text.json_list) == ["not json"]
    assert one(spark, None, text.json_list) == [] and one(spark, " ", text.json_list) == []
    assert one(spark, "07-01. Smart/app (new)", text.label_tokens) == ["Smart", "app", "new"]
    assert one(spark, [" A ", "a", "", None, "b"], lambda c: text.term_list(c, 5), "array<string>") == ["A", "b"]
    assert one(spark, ["x"] * 3 + ["y", "z"], lambda c: text.term_list(c, 2), "array<string>") == ["x", "y"]


def test_numbers(spark):
    r = spark.createDataFrame([(1, 0, [0.0, 0.0], [3.0, 4.0])], "a int, b int, z array<double>, v array<double>").select(
        ratio(F.col("a"), F.col("b")).alias("r"), unit(F.col("z")).alias("z"), unit(F.col("v")).alias("v"), dot(F.col("z"), F.array(F.lit(1.0))).alias("d")
    ).first()
    assert r["r"] == 0.0 and r["z"] == [None, None] and r["v"] == [0.6, 0.8] and r["d"] is None
