"""Operators on training data against brute force, exact round trips, SQL and held-out labels."""

import itertools
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from compare import assert_same, connect
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from memoloom.llm import abuse, clusters, copies, language, leakage, neardup, neighbours, tokens, vectors
from memoloom.llm import queries as q
from memoloom.llm.common import fields, fold, words
from memoloom.llm.components import connected_components
from memoloom.llm.oracles import SQL
from memoloom.llm.sampling import sample_to_targets
from memoloom.llm.topn import top_n

TEXTS = "id long, memo string"
G = ["g"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, data, name):
    assert_same(q.queries()[name](spark, data), connect(data), SQL[name])


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(SQL)))
def test_runs(spark, data, name):
    assert q.queries()[name](spark, data).columns


# 1


def sampled(spark, rows, targets, **kw):
    df = spark.createDataFrame(rows, "g string, unit string, memo string, ord long, _g0 string, tid string")
    t = spark.createDataFrame(targets, "g string, target_share double, min_rows int, sample_rows int")
    s, r = sample_to_targets(df, t, G, "unit", "memo", "ord", **kw)
    return s.collect(), {x["g"]: x for x in r.collect()}


def test_sample_is_exact_and_reports_deficits(spark):
    rows = [("a", f"u{i % 700}", "m", i, "x", "y") for i in range(1400)] + [(None, f"n{i}", "m", i, "x", "y") for i in range(5)] + [("b", "u", " ", 1, "x", "y"), ("b", None, "m", 2, "x", "y"), ("z", "u", "m", 3, "x", "y")]
    targets = [("a", 0.5, 0, 1000), (None, None, 3, 1000), ("b", float("nan"), 2, 1000), ("c", 0.0005, None, 1000), ("d", 0.0, 0, None)]
    s, r = sampled(spark, rows, targets)
    n = Counter(x["g"] for x in s)
    assert n == {"a": 500, None: 3}
    assert len({(x["g"], x["unit"]) for x in s}) == 503
    assert (r["b"]["needed"], r["b"]["observed"], r["b"]["deficit"]) == (2, 0, 2)
    assert r["c"]["needed"] == 1 and r["c"]["deficit"] == 1 and r["d"]["needed"] == 0
    assert 0.7 < r["a"]["acceptance"] < 1 and 500 <= r["a"]["accepted"] < 700
    assert sorted(map(str, s)) == sorted(map(str, sampled(spark, rows[::-1], targets)[0]))
    assert sampled(spark, [], targets)[0] == [] and sampled(spark, rows, [])[1] == {}


def test_acceptance_changes_what_is_accepted_and_never_what_is_drawn(spark):
    rows = [("a", f"u{i}", "m", i, "x", "y") for i in range(3000)] + [("b", f"u{i}", "m", i, "x", "y") for i in range(40)]
    runs = [sampled(spark, rows, [("a", 0.5, 0, 1000), ("b", 0.5, 0, 100)], oversample=o) for o in (-0.6, 0.05, 1.0)]
    first = sorted(map(str, runs[0][0]))
    assert len(first) == 540 and all(sorted(map(str, s)) == first for s, _ in runs)
    accepted = [r["a"]["accepted"] for _, r in runs]
    assert accepted[0] < 500 <= accepted[1] < accepted[2] < 3000  # the first comes out short and is refilled
    assert [r["b"]["deficit"] for _, r in runs] == [10, 10, 10]


def test_sample_takes_all_of_a_small_group(spark):
    s, r = sampled(spark, [("a", f"u{i}", "m", i, "", "") for i in range(40)], [("a", 1.0, 0, 50)], broadcast_rows=0)
    assert len(s) == 40 and r["a"]["deficit"] == 10


# 2


def similarity(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def near_found(spark, rows, **kw):
    pairs, members = neardup.near_pairs(spark.createDataFrame(rows, TEXTS + ", n int, key long"), "id", "memo", **kw)
    got = {(r["id_a"], r["id_b"]) for r in neardup.expand(pairs, members).collect()}
    want = {(i, j) for (i, a, *_), (j, b, *_) in itertools.combinations(sorted(x for x in rows if x[1]), 2) if len(words(a)) >= 8 <= len(words(b)) and similarity(a, b) >= 0.8 - 1e-9 and not copies.same_text(a, b) and i != j}
    return got, want, (pairs, members)


def variants(n, seed, vocabulary=40):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        w = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(9, 24))] + [f"name{rng.randrange(10**6)}"]
        for _ in range(rng.randrange(1, 4)):
            v = list(w)
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(v))
                rng.choice([lambda: v.pop(k), lambda: v.insert(k, f"x{rng.randrange(99)}"), lambda: v.insert(0, v.pop(k))])()
            out.append(" ".join(v))
    return out


def test_near_pairs_equal_brute_force(spark):
    texts = [*variants(60, 1), None, "", "short one", "A B C D E F G H", "a. b. c. d. e. f. g. h.", "h g f e d c b a"]
    rows = [(i, t, 0, 0) for i, t in enumerate(texts)]
    got, want, made = near_found(spark, rows)
    assert got == want and len(want) > 20
    groups = neardup.near_groups(*made).collect()
    assert {r["id"] for r in groups} == {i for p in want for i in p}
    # keys that are too large are divided by words, then into tiles, and lose nothing
    assert near_found(spark, rows, crowded=3)[0] == want
    assert near_found(spark, rows, crowded=1)[0] == want
    assert near_found(spark, rows[:0])[0] == set()


def test_crowded_keys_keep_every_pair(spark):
    rng = random.Random(3)
    stock = [f"stock{i}" for i in range(16)]
    texts = [" ".join([*stock[:i], f"own{rng.randrange(40)}", *stock[i:], f"my{rng.randrange(40)}"]) for i in [rng.randrange(16) for _ in range(150)]]
    rows = [(i, t, 0, 0) for i, t in enumerate(texts)] + [(1000 + i, texts[0], 0, 0) for i in range(40)]
    got, want, _ = near_found(spark, rows, crowded=20)
    assert got == want and len(want) > 9_000


def test_bands_keep_the_chance_of_a_miss_at_any_size():
    for n in (1, 10**6, 10**8, 10**10):
        bands, length = neardup.banding(n, 0.8)
        assert (1 - 0.8**length) ** bands <= neardup.MISSED
    assert neardup.banding(10**10, 0.8)[1] > neardup.banding(1, 0.8)[1]


def test_pairs_whose_rare_words_are_edits_of_one_end(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefghij", k=7)) for _ in range(60)]
    texts = [rng.sample(vocabulary, 30) for _ in range(400)]
    texts += [t[:27] + ["slip" + "klmnopqrstuvwxyzabcd"[i] + c for c in "xyz"] for i, t in enumerate(texts[:20])]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], TEXTS)
    pairs, _ = neardup.near_pairs(df, "id", "memo")
    assert {(r["rep_a"], r["rep_b"]) for r in pairs.collect()} >= {(i, 400 + i) for i in range(20)}


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 4, 30), rng.integers(0, 4, 30)
    e = rng.integers(0, 2**62, 30).astype(np.uint64)
    want = sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in range(30)) for i in range(30) if x[i] and y[i])
    d = np.r_[np.zeros((x > 0).sum(), int), np.ones((y > 0).sum(), int)]
    s = neardup.prob_min_hash(d, np.r_[e[x > 0], e[y > 0]], np.r_[x[x > 0], y[y > 0]].astype(float), 2, 4096)
    assert (s[0] == s[1]).mean() == pytest.approx(want, abs=0.04)


# 3


def test_copies(spark):
    accent = unicodedata.normalize("NFD", "Résumé of the télévision, complete")
    rows = [
        (1, "a", "Résumé of the télévision, complete"),
        (2, "a", accent.upper()),
        (3, "a", "résumé of​ the TÉLÉVISION complete!!"),
        (4, "b", "Résumé of the télévision, complete"),
        (5, None, "Picture: very good; Sound: rather dull; Price: high"),
        (6, None, "price = HIGH | sound=rather dull|picture=very  good"),
        (7, None, "picture very good sound rather dull price high"),
        (8, None, "Picture: very good; Sound: rather dull"),
        (9, "a", "short"),
        (10, "a", "short"),
        (11, "a", None),
        (12, None, "sound: rather dull; picture: very good; price: high; price: high"),
        (12, None, "sound: rather dull; picture: very good; price: high; price: high"),
        (13, "c", "ISINIYOR ÇOK GÜZEL TELEVİZYON"),
        (14, "c", "ısınıyor çok güzel televizyon"),
    ]
    df = spark.createDataFrame(rows, "id long, g string, memo string").withColumn("key", F.lit(1))
    got = sorted((r["first_id"], r["copy_id"]) for r in copies.format_copies(df, G, "id", "memo").collect())
    assert got == [(1, 2), (1, 3), (5, 6), (5, 7), (13, 14)]
    assert copies.format_copies(df.limit(0), G, "id", "memo").count() == 0


def test_chains_of_field_lists(spark):
    rows = [(1, "aa: bbbbbbbb; cc: dddddddd; ee: ffffffff"), (2, "ee: ffffffff; cc: dddddddd; aa: bbbbbbbb"), (3, "aab: bbbbbbb; cc: dddddddd; ee: ffffffff"), (4, "ee: ffffffff; aab: bbbbbbb; cc: dddddddd")]
    df = spark.createDataFrame(rows, TEXTS).withColumn("g", F.lit(1))
    assert sorted(r["copy_id"] for r in copies.format_copies(df, G, "id", "memo").collect()) == [2, 3, 4]


def test_fields():
    assert fields("a: 1; b: 2; c: 3") == ["a\x1f1", "b\x1f2", "c\x1f3"]
    assert fields("a: 1; b: 2") is None and fields("a: 1; b: 2; prose") is None and fields("x") is None


# 4 and 7


def cloud(spark, seed=3, noise=0.03):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((25, 16))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), rng.integers(1, 14, 25), axis=0)
    x = (x + noise * rng.standard_normal(x.shape)).astype(np.float32) * rng.uniform(0.5, 5, (len(x), 1)).astype(np.float32)
    rows = [(f"m{i:04}", v.tolist(), "enc") for i, v in enumerate(x)]
    bad = [("bad1", None, "enc"), ("bad2", [0.0] * 16, "enc"), ("bad3", [float("nan")] + [1.0] * 15, "enc"), ("bad4", [1.0], "enc"), ("bad5", x[0].tolist(), "other"), (None, x[0].tolist(), "enc"), ("bad6", [None] + [1.0] * 15, "enc")]
    df = spark.createDataFrame(rows + rows[:5] + bad, "memo_id string, v array<float>, model string").withColumn("vid", F.lit("clash"))
    return df, {r[0]: v for r, v in zip(rows, vectors.matrix(__import__("pandas").Series([r[1] for r in rows])))}


def linked(x):
    ids = sorted(x)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(ids, 2):
        if x[a] @ x[b] >= 0.8:
            r, s = sorted((find(a), find(b)))
            root[s] = r
    size = Counter(find(i) for i in ids)
    return {(find(i), i) for i in ids if size[find(i)] >= 3 and find(i) != i}


def test_clusters_equal_brute_force(spark):
    df, x = cloud(spark)
    v = vectors.load(df, "memo_id", "v", 16, "model", "enc")
    assert v.n == len(x)
    members, assigned = clusters.clusters(v)
    got = {(r["first_id"], r["id"]) for r in members.where("vid > cluster").collect()}
    assert got == linked(x) and len(got) > 50
    labels = spark.createDataFrame([(i, "t" if k % 3 else "u") for k, i in enumerate(sorted(x))], "id string, topic string")
    d = clusters.described(members, assigned, labels).collect()
    assert sum(r["size"] for r in d) == len(got) + len({a for a, _ in got})
    assert all(len(r["typical"]) == min(5, r["size"]) and sum(t["n"] for t in r["topics"]) == r["size"] for r in d)
    assert clusters.linked(v, assigned, 0.8, tile_rows=4).select("vid", "cluster").distinct().count() == clusters.linked(v, assigned, 0.8).count()
    none = vectors.load(df.where("model = 'none'"), "memo_id", "v", 16)
    whole = clusters.clusters(v, exact=True)[0]
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, members.collect()))
    assert clusters.clusters(none)[0].count() == 0


def test_the_mixture_is_that_of_all_vectors(spark):
    n, rng = 34_000, np.random.default_rng(5)
    x = (np.repeat(np.eye(6)[:2], n // 2, axis=0) + 0.3 * rng.standard_normal((n, 6))).astype(np.float32)
    v, other = (vectors.load(spark.createDataFrame(list(zip(i.tolist(), x.tolist())), "id long, v array<float>"), "id", "v", 6) for i in (np.arange(n), rng.permutation(n)))
    # nothing depends on which ids the vectors have
    a, b = clusters.fit(v, components=(2, 4)), clusters.fit(other, components=(2, 4))
    assert len(a.weight) == len(b.weight) > 1
    assert all(np.allclose(getattr(a, k), getattr(b, k), atol=1e-6) for k in ("weight", "centre", "cov"))
    # a single cell lies at the mean of all vectors
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    mean = unit.mean(0) / np.linalg.norm(unit.mean(0))
    for cells in clusters.fit(v, components=(), per_cell=10**9).covers:
        assert np.allclose(cells.centre, mean[None], atol=1e-5)


def test_forest_of_dense_rows():
    rng = np.random.default_rng(1)
    x = np.repeat(np.eye(8)[:3], [900, 400, 1], axis=0) + 0.05 * rng.standard_normal((1301, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    p = clusters.forest(x, 0.8, block=128)
    assert len(set(p[:900])) == 1 and len(set(p[900:1300])) == 1 and len(set(p)) == 3


def test_neighbours_equal_brute_force(spark):
    df, x = cloud(spark)
    v = vectors.load(df, "memo_id", "v", 16, "model", "enc")
    got = {}
    for r in neighbours.with_ids(v, neighbours.nearest(v, 5)).collect():
        got.setdefault(r["id"], {})[r["rank"]] = (r["neighbour_id"], r["cosine"])
    for i in x:
        want = sorted(((-(x[i] * x[j]).sum(), j) for j in x if j != i))[:5]
        assert [got[i][k + 1][0] for k in range(5)] == [j for _, j in want]
        assert got[i][1][1] == pytest.approx(-want[0][0])
    none = vectors.load(df.where("model = 'none'"), "memo_id", "v", 16)
    sure = neighbours.exact_nearest(v, v.rows.where("vid % 3 = 0"), 5).select("vid", "rank", "neighbour").collect()
    close = {(r["vid"], r["neighbour"]) for r in neighbours.nearest(v, 5).collect()}
    assert len(sure) == 5 * v.rows.where("vid % 3 = 0").count() and np.mean([(r["vid"], r["neighbour"]) in close for r in sure]) >= 0.9
    with pytest.raises(ValueError):
        neighbours.exact_nearest(v, v.rows, most=3)
    assert neighbours.orderings(10) == 12 < neighbours.orderings(10**7) < neighbours.orderings(10**10)
    assert neighbours.nearest(none).count() == 0


def test_ties_go_to_the_smaller_id(spark):
    df = spark.createDataFrame([(f"m{i}", [1.0, 0.0]) for i in range(9)], "memo_id string, v array<float>")
    v = vectors.load(df, "memo_id", "v", 2)
    r = neighbours.with_ids(v, neighbours.nearest(v, 2)).where("id = 'm5'").orderBy("rank").collect()
    assert [x["neighbour_id"] for x in r] == ["m0", "m1"]


def by_force(x, ids, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    return {(ids[i], r + 1, ids[j]) for i in range(len(u)) for r, j in enumerate([j for j in np.lexsort((np.arange(len(u)), -np.round((u * u[i]).sum(1), 12))) if j != i][:k])}


def test_large_groups_of_equal_vectors(spark):
    rng = np.random.default_rng(8)
    c = rng.standard_normal((40, 8))
    x = np.concatenate([np.repeat(c[:1], 700, axis=0), np.repeat(c[1:2], 3, axis=0), c[2:], 2 * c[:1]])[rng.permutation(742)].astype(np.float32)
    ids = [f"m{i:04}" for i in range(len(x))]
    v = vectors.load(spark.createDataFrame(list(zip(ids, x.tolist())), "memo_id string, v array<float>"), "memo_id", "v", 8)
    got = {(r["id"], r["rank"], r["neighbour_id"]) for r in neighbours.with_ids(v, neighbours.nearest(v, 5)).collect()}
    assert got == by_force(x, ids, 5)


def test_windows_pass_the_borders_of_tasks(spark):
    x = np.random.default_rng(9).standard_normal((300, 4)).astype(np.float32)
    ids = [f"m{i:04}" for i in range(len(x))]
    v = vectors.load(spark.createDataFrame(list(zip(ids, x.tolist())), "memo_id string, v array<float>"), "memo_id", "v", 4)
    # one curve, whose window holds all rows, in tasks of fewer rows than it
    got = {(r["id"], r["rank"], r["neighbour_id"]) for r in neighbours.with_ids(v, neighbours.nearest(v, 5, curves=1, dims=4, window=300, part_rows=40)).collect()}
    assert got == by_force(x, ids, 5)


def test_recall_on_larger_data(spark):
    rng = np.random.default_rng(5)
    c = rng.standard_normal((400, 32))
    x = np.repeat(c / np.linalg.norm(c, axis=1, keepdims=True), 8, axis=0) + 0.04 * rng.standard_normal((3200, 32))
    df = spark.createDataFrame([(f"m{i:05}", r.tolist()) for i, r in enumerate(x)], "memo_id string, v array<float>")
    v = vectors.load(df, "memo_id", "v", 32)
    found = neighbours.with_ids(v, neighbours.nearest(v, 5, window=64)).collect()
    got = {(r["id"], r["neighbour_id"]) for r in found}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    ask = range(0, 3200, 100)
    want = {(f"m{i:05}", f"m{j:05}") for i in ask for j in np.argsort(-(u @ u[i]))[1:6]}
    assert len(want & got) >= 0.9 * len(want)


def test_hilbert_curve_moves_one_step_at_a_time():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    order = cells[np.argsort(neighbours.hilbert(cells, 3))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101), (101, 100), (7, 7), (200, 201), (201, 202), (202, 200)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0, 100, 200} and got[30] == 0 and got[202] == 200
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# 5

EN, DE, JA = "The picture is very sharp and the sound works well with my old player.", "Das Bild ist sehr scharf und der Ton funktioniert gut mit meinem alten Gerät.", "画面は本当にきれいで満足です。音声検索は期待はずれでした。"
MORE = {
    "en": [EN, "The remote stopped working after a week and nobody answers the help line.", "This menu is easy to use and looks good on the wall of our kitchen."],
    "de": [DE, "Die Fernbedienung hängt ständig und niemand antwortet auf meine Fragen.", "Das Menü ist einfach zu bedienen und sieht an der Wand der Küche gut aus."],
    "ja": [JA, "リモコンはよく固まって困ります。メニュー画面は反応が遅くて残念です。", "電源ケーブルは値段の価値があります。本体はすぐに熱くなります。"],
}


def test_languages(spark):
    country = {"en": "US", "de": "DE", "ja": "JP"}
    rng = random.Random(2)
    train = [(i, " ".join(rng.sample(MORE[x], 2)), country[x]) for i, x in enumerate(["en", "de", "ja"] * 20)]
    ask = [
        (100, EN, "us "),
        (101, DE, "US"),
        (102, f"{EN} {EN} {DE} {EN}", "US"),
        (103, f"{JA} -- {EN} {EN}", None),
        (104, "ok gut", "US"),
        (105, None, "US"),
        (106, "", "US"),
        (107, "XF81449 HV63000 12345 67890 ZC27443 99999", "US"),
        (108, f"{EN} {EN} Sehr gut.", "US"),
        (109, " ".join([EN] * 400), "US"),
    ]
    df = spark.createDataFrame(train + ask, TEXTS.replace("memo", "memo") + ", country string").withColumn("lang", F.lit("clash"))
    allowed = spark.createDataFrame([("US", "en"), ("DE", "de"), ("JP", "ja"), ("CH", "de"), ("CH", "fr"), (None, "x")], "country string, lang string")
    got = {}
    for r in language.languages(df, "id", "memo", "country", allowed).where("id >= 100").collect():
        got.setdefault(r["id"], {})[r["seg_no"]] = (r["lang"], r["fits"])
        assert 0.5 <= r["confidence"] <= 1
    assert got[100] == {0: ("en", True)} and got[101] == {0: ("de", False)}
    assert got[102] == {0: ("en", True), 1: ("en", True), 2: ("de", False), 3: ("en", True)}
    assert {k: v[0] for k, v in got[103].items()} == {0: "en", 1: "ja", 2: "en"} or {k: v[0] for k, v in got[103].items()} == {0: "ja", 1: "ja", 2: "en"}
    assert not {104, 105, 106, 107} & set(got)
    assert got[108] == {0: ("en", True)} and got[109] == {0: ("en", True)}
    assert language.languages(df.limit(0), "id", "memo", "country", allowed).count() == 0
    assert language.languages(df, "id", "memo", "country", allowed.limit(0)).count() == 0


# 6


def test_top_n(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", i, s) for i, s in enumerate([1.0, 3.0, 3.0, nan, None, inf, 2.0])] + [(None, 9, 1.0), ("b", 5, 1.0), ("b", 5, 1.0), ("A", 7, -1.0)]
    df = spark.createDataFrame(rows, "g string, id long, s double").withColumn("_rank", F.lit(1))
    got = sorted((r["g"], r["rank"], r["id"]) for r in top_n(df, G, "s", "id", 3).collect())
    assert got == [("A", 1, 7), ("a", 1, 5), ("a", 2, 1), ("a", 3, 2), ("b", 1, 5), ("b", 2, 5)]
    assert top_n(df.limit(0), G, "s", "id").count() == 0
    plan = top_n(df, G, "s", "id")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


# 8


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab '\n\t.,1é日👍<|>s", max_size=120), st.integers(4, 20), st.integers(1, 12))
def test_pieces_encode_like_the_whole(text, chunk, overlap):
    enc = tokens.encoding()
    want = enc.encode_ordinary(text)
    assert [i for a, b in tokens.pieces(text, chunk, overlap) for i in enc.encode_ordinary(text[a:b])] == want
    spans = [s for k in range(-(-len(text) // chunk)) if (s := tokens._span(text, k, chunk, overlap)) is not None]
    assert "".join(spans) == text and [i for s in spans for i in enc.encode_ordinary(s)] == want
    assert tokens.decode(want) == text


def test_encode_texts(spark):
    texts = [None, "", "hello <|endoftext|> world", "x" * 3000, "it's   a\r\n\ttest " * 300, "日本語のテキスト" * 200, "a" + " " * 2500 + "b", "hello"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit(0)).withColumn("row", F.lit(0))
    both = df.unionAll(df.where("doc_id = 7"))
    want = {i: tokens.encoding().encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    for kw in ({}, {"chunk": 100, "overlap": 30}):
        got = tokens.encode_texts(both, "doc_id", "text", **kw).collect()
        assert len(got) == 9 and all(r["ids"] == want[r["doc_id"]] for r in got)
    assert tokens.encode_texts(df.limit(0), "doc_id", "text").count() == 0


# 9


def test_leaks_equal_brute_force(spark):
    rng = random.Random(4)
    item = [" ".join(f"i{k}w{j}" for j in range(20)) for k in range(4)] + ["too short", None, ""]
    w = item[0].split()
    docs = [
        " // ".join(w[3:16]).upper(),
        " ".join(w[:12]),
        "x " + "\n+ ".join(w),
        " ".join(w[:6] + ["other"] + w[7:14]),
        None,
        "",
        " ".join(item[1].split()[:13] + item[2].split()[7:20]),
        " ".join(rng.sample(w, 20)),
    ]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").withColumn("h", F.lit("clash"))
    i = spark.createDataFrame(list(enumerate(item)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text").collect()}
    exact = {k for k, r in got.items() if r["exact_words"] >= 13}
    assert exact == {(0, 0), (2, 0), (6, 1), (6, 2)}
    assert got[0, 0]["exact_words"] == 13 and got[2, 0]["exact_words"] == 20
    assert got[3, 0]["exact_words"] == 0 and (got[3, 0]["matched"], got[3, 0]["passage_words"]) == (13, 14)
    assert leakage.leaks(d.limit(0), "doc_id", "text", i, "item_id", "text").count() == 0
    assert leakage.leaks(d, "doc_id", "text", i.limit(0), "item_id", "text").count() == 0


def test_leaks_of_edited_passages(spark):
    rng = random.Random(8)
    items = [[f"i{k}w{rng.randrange(60)}" for _ in range(rng.randrange(20, 50))] for k in range(60)]

    def edited(w, share):
        out = []
        for x in w:
            kind = rng.random() / share if share else 9
            out += [] if kind < 0.2 else ["new", x] if kind < 0.4 else ["other"] if kind < 1 else [x]
        return out

    docs = []
    for k, w in enumerate(items):
        for share in (0.0, 0.05, 0.1, 0.2):
            docs.append((k, share, ["lead"] * rng.randrange(9) + edited(w, share) + ["tail"] * rng.randrange(9)))
    text = lambda w: " ".join(w)
    d = spark.createDataFrame([(n, text(w)) for n, (*_, w) in enumerate(docs)], "doc_id long, text string")
    i = spark.createDataFrame([(n, text(w)) for n, w in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text").collect()}

    # against the alignment on every diagonal, without seeds
    cache, want = {}, set()
    for n, (k, _, w) in enumerate(docs):
        x, y = leakage._hashes(w, cache), leakage._hashes(items[k], cache)
        m, size = leakage.align([x] * (len(x) + len(y)), [y] * (len(x) + len(y)), np.arange(-len(y), len(x)))
        if ((size >= 13) & (m >= 0.7 * size)).any():
            want.add((n, k))
    assert set(got) <= want
    share = lambda s: np.mean([p in got for p in want if docs[p[0]][1] == s])
    print([round(share(s), 3) for s in (0.0, 0.05, 0.1, 0.2)])
    assert share(0.0) == 1 and share(0.05) >= 0.95 and share(0.1) >= 0.9 and share(0.2) >= 0.5


def test_a_hit_without_enough_agreement_around_it_fails(spark):
    item = [f"w{j}" for j in range(30)]
    lone = [w if c == "1" else "other" for w, c in zip(item[5:18], leakage.MASKS[3])]  # all that this mask looks at, no more
    d = spark.createDataFrame([(1, " ".join(["x"] * 9 + lone + ["y"] * 9)), (2, " ".join(item[:5] + lone + item[18:]))], "doc_id long, text string")
    i = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r for r in leakage.leaks(d, "doc_id", "text", i, "item_id", "text").collect()}
    assert set(got) == {2} and got[2]["matched"] == 25 and got[2]["passage_words"] == 30


# 10


def test_content_scores_on_held_out_labels(spark):
    rng = random.Random(6)
    bad = {"abusive": ["shut up you {} fool", "only a {} like you would merge this"], "hateful": ["no {} people allowed in this repo", "keep {} people off the list"], "sexual": ["send me your {} pics tonight", "come to my room and {} me all night"]}
    fill = ["awful", "stupid", "naked", "dirty", "filthy"]
    clean = ["fix the loop in the {} parser", "add a test for {} input", "the idiot proof {} handler", "return buffer(x);", "rename the {} column"]

    def text(kind):
        lines = [rng.choice(clean).format(rng.choice(["old", "new", "small"])) for _ in range(6)]
        if kind:
            lines.insert(rng.randrange(6), "// " + rng.choice(bad[kind]).format(rng.choice(fill)))
        return "\n".join(lines)

    kinds = [rng.choice([None, None, *bad]) for _ in range(700)]
    docs = [(i, text(k), "s" if i % 2 else "t", 1) for i, k in enumerate(kinds)] + [(1000, None, "s", 1), (1001, "", "s", 1), (1, text(kinds[1]), "s", 1)]
    labels = [(i, *[int(k == x) for x in abuse.KINDS]) for i, k in enumerate(kinds[:400])] + [(3, None, None, None), (None, 1, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string, score int")
    lab = spark.createDataFrame(labels, "doc_id long, abusive int, hateful int, sexual int")
    s = abuse.content_scores(d, "doc_id", "text", lab, "doc_id", ("source",)).collect()
    assert len(s) == len(docs)
    held = [r for r in s if 400 <= r["doc_id"] < 700]
    right = sum(all(r[f"{x}_found"] == (kinds[r["doc_id"]] == x) for x in abuse.KINDS) for r in held)
    assert right >= 0.95 * len(held)
    assert not any(r[f"{x}_found"] or r[x] for r in s if r["doc_id"] >= 1000 for x in abuse.KINDS)
    out = abuse.content_scores(d, "doc_id", "text", lab, "doc_id", ("source",))
    assert {r["source"] for r in abuse.rates(out, "source").collect()} == {"s", "t"}
    assert abuse.found(abuse.content_scores(d, "doc_id", "text", lab.limit(0), "doc_id"), "doc_id").count() == 0
    assert abuse.content_scores(d.limit(0), "doc_id", "text", lab, "doc_id").count() == 0


def test_many_positive_labels_leave_room_for_others(spark, monkeypatch):
    seen = {}
    real = abuse.fit
    monkeypatch.setattr(abuse, "fit", lambda *a, **kw: seen.update(label=a[3], **kw) or real(*a, **kw))
    d = spark.createDataFrame([(i, "you fool" if i < 200 else "fix the loop") for i in range(800)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 200), 0, 0) for i in range(800)], "doc_id long, abusive int, hateful int, sexual int")
    for most, pos, neg in ((90, 30, 60), (700, 200, 500), (800, 200, 600), (900, 200, 600)):
        abuse.train(d, "doc_id", "text", lab, "doc_id", most)
        y = seen["label"][:, 0] == 1
        assert (y.sum(), (~y).sum()) == (pos, neg)
        assert seen["stands_for"][y].sum() == pytest.approx(200) and seen["stands_for"][~y].sum() == pytest.approx(600)
    abuse.train(d, "doc_id", "text", lab.where("doc_id < 210"), "doc_id", 90)
    assert (seen["label"][:, 0] == 1).sum() == 80


def test_threshold_counts_what_a_label_stands_for():
    # 20 positives and 20 negatives alike: at equal numbers to find all is best, where negatives stand for 50 it isn't
    label = np.zeros((40, 3), int)
    label[::2, 0] = 1
    sizes, doc = np.ones(40, np.int64), np.arange(40)
    cells = np.where(np.arange(40) < 36, 7, np.where(np.arange(40) % 2 == 0, 8, 9))
    plain = abuse.fit(sizes, cells, doc, label, 1)
    heavy = abuse.fit(sizes, cells, doc, label, 1, stands_for=np.where(label[:, 0] == 1, 1.0, 50.0))
    assert heavy.threshold[0] >= plain.threshold[0]


def test_only_headers_are_skipped():
    kept = ["--- you are a complete jackass", "from a stale token.", "index must not depend on the limit", "rename master and slave", "date: never", "naked,dirty;fool" * 4]
    for line in kept:
        assert abuse.units(line) == [abuse._TERM.findall(line)], line
    assert ["you", "jackass"] in abuse.units("@@ -1,2 +1,3 @@ you jackass")
    body = "zcmv" + "a" * 62
    head = ["diff --git a/x.sql b/x.sql", "similarity index 90%", "rename from x.sql", "rename to y.sql", "index dff9d25..3f1b355 100644", "--- a/x.sql", "+++ /dev/null", "commit " + "0f" * 20, "From " + "0f" * 20 + " Mon Sep 17 00:00:00 2001", "Author: a b <a@b.example>", "Date:   Sun Feb 11 04:27:18 2024 +0000", "GIT binary patch", "literal 66609", body, body]
    assert not abuse.units("\n".join(head))
    assert abuse.units(body) and abuse.units("literal 5\n" + body + "\n\n" + body)


def test_hidden_terms_are_read():
    assert abuse.units("you d i m w i t") == [["you", "dimwit"]]
    assert abuse.units("such t.i.t.s") == [["such", "tits"]]
    assert abuse.units("1mb3c1l3 hornyyy c****n dumbаss") == [["imbecile", "horny", "c*n", "dumbass"]]


def test_folding():
    assert fold("İI") == "ii" and fold("é​") == "é" and words("Don't­ stop_it 2x") == ["don", "t", "stop", "it", "2x"]
