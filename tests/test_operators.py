"""Properties of operators: idempotence, conservation, determinism, and defects that must not return."""

import pytest
from pyspark.sql import functions as F

from memoloom import boundary
from memoloom.config import Classifying, Settings
from memoloom.functions.identity import GROUP, VERSION, with_memo_id
from memoloom.operators import classify as cl
from memoloom.operators import dims, joins, report, review, rows, sampling
from memoloom.operators import vectors as vec
from memoloom.plans import pipeline
from memoloom.plans.queries import Tables
from memoloom.schemas import conform, empty, ensure, require, schema
from memoloom.sources.registry import Registry, eligible
from memoloom.sources.store import Store

G = "cate_1_depth string, cate_2_depth string, sc_measurement int"
V = "prompt_version string, taxonomy_version string, model_version string"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def groups(spark, n=1):
    return spark.createDataFrame([("01. Sound", "01-01. Remote app", 1)] * n, G)


def profile(spark):
    return groups(spark).withColumns({"overall_topic_name": F.lit("Overall good"), "overall_sentiment_terms_json": F.lit('["great", "good"]'), "feature_hint_terms_json": F.lit('["battery"]'), "reason_signal_terms_json": F.lit('["because"]')})


def pool(spark):
    data = [("Battery life", "how long the battery lasts", '["battery died"]'), ("Channel list", "order of channels", "[]"), ("Overall good", "", None)]
    return groups(spark).crossJoin(spark.createDataFrame(data, "topic string, description string, representative_memos_json string"))


def memos(spark, *texts):
    return groups(spark).crossJoin(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "memo_id string, memo string"))


def test_classify(spark):
    texts = ("great remote", "Great!!", "great but the battery is slow because old", "channel list order", "zzz", "battery channel")
    got = {r["memo_id"]: r for r in cl.classify(memos(spark, *texts), dims.profiles(profile(spark)), dims.topics(pool(spark))).collect()}
    assert got["0"]["classification_stage"] == "rule_overall_target_sentiment" and got["0"]["pred_topic"] == "Overall good" and got["0"]["confidence_score"] == 0.99
    assert got["1"]["classification_stage"] == "rule_overall"
    assert got["2"]["pred_topic"] == "Battery life"
    assert got["3"]["pred_topic"] == "Channel list" and got["3"]["pred_topic_type"] == "topic"
    assert got["4"]["classification_stage"] == "forced_others" and got["4"]["pred_topic"] == "기타" and got["4"]["review_needed_yn"]
    assert len(got) == 6


def score(memo, name, told, shown, hints, features):
    low, words = memo.lower(), set(memo.lower().split())
    s = 1.2 * len(words & set(name.lower().split())) + 0.85 * len(words & set(told.lower().split())) + 0.05 * len(words & set(shown.lower().split()))
    for f in features:
        if f in low:
            s += 1.25 if f in name.lower() else 0.85 if f in told.lower() else 0
    return round(s + sum((2.0 if " " in h else 1.4) for h in hints if h in low), 4)


def test_scores_follow_the_specification(spark):
    p = dims.topics(pool(spark))
    known = {r["topic"]: r for r in p.collect()}
    m = memos(spark, "the battery lasts", "battery died after a day", "channels in order", "nothing")
    m = m.withColumn("feature_hint_terms", F.array(F.lit("battery"))).withColumn("overall_topic_name", F.lit("Overall good"))
    got = {(r["memo_id"], c["topic"]): c["score"] for r in cl.candidates(m, p).collect() for c in r["shortlist"]}
    for r in m.collect():
        for t, k in known.items():
            want = score(r["memo"], t, k["description"], " ".join(k["memos"]), k["hints"], ["battery"]) if t != "Overall good" else 0
            assert got.get((r["memo_id"], t), 0) == pytest.approx(want)


def test_margin_and_rescue(spark):
    topics = dims.topics(pool(spark))
    tie = cl.classify(memos(spark, "battery list"), dims.profiles(profile(spark)), topics, Classifying(min_margin=100.0)).first()
    assert tie["pred_topic_type"] == "ambiguous" and tie["pred_topic"] == "기타"
    base = memos(spark, "x", "y").withColumns({"classification_stage": F.lit("llm_fallback"), "pred_topic": F.lit("기타"), "pred_topic_type": F.lit("others"), "review_needed_yn": F.lit(True)})
    df = base.withColumn("match_reason", F.when(F.col("memo") == "x", "it is Battery life").otherwise("Battery life or Channel list"))
    got = {r["memo"]: r for r in cl.rescue(df, topics).collect()}
    assert got["x"]["pred_topic"] == "Battery life" and got["x"]["classification_stage"] == "llm_reason_recovered"
    assert got["y"]["pred_topic"] == "기타"


def test_model_answers(spark):
    assert boundary.checked({"pred_topic": "O"}, ["A"], "O", "기타") == ("O", "overall", "", False)
    assert boundary.checked({"pred_topic": "B"}, ["A"], "O", "기타")[2] == "llm_returned_unknown_topic"
    assert boundary.checked("junk", ["A"], None, "기타")[:2] == ("기타", "others")
    assert boundary.loose_json('```json\n{"a": [1, 2,],}\n```') == {"a": [1, 2]}
    assert boundary.loose_json('text {"a": 1} more') == {"a": 1}
    assert boundary.inference_options({"top_p": 0.9, "temperature": 0.1}) == {"top_p": 0.9}
    waits = []
    with pytest.raises(RuntimeError):
        boundary.with_retry(lambda: 1 / 0, 3, 2.0, waits.append)
    assert waits == [2.0, 4.0]
    with pytest.raises(ValueError):
        boundary.topic_pool_rows([{"topic": "A"}, {"topic": "a"}], "O", 3, 5)
    assert [t["topic"] for t in boundary.topic_pool_rows([{"topic": "A"}, {"topic": "o"}, {"topic": "B"}], "O", 2, 2)] == ["O", "A"]
    assert boundary.profile_terms({"feature_hint_terms": ["A ", "a", ""]})["feature_hint_terms"] == ["A"]
    df = cl.classify(memos(spark, "zzz", "great remote"), dims.profiles(profile(spark)), dims.topics(pool(spark)))
    out = {r["memo_id"]: r for r in boundary.model_fallback(df, dims.topics(pool(spark)), boundary.RuleModel()).collect()}
    assert out["0"]["llm_used_yn"] and out["0"]["confidence_score"] is None and not out["1"]["llm_used_yn"]


def test_store_replaces_by_key(spark, store):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), ("y", 4)], "k string, v int")
    store.write("t", a, "overwrite")
    new = spark.createDataFrame([("x", 9), (None, 8)], "k string, v int")
    for _ in range(2):
        store.write("t", new, "replace", ("k",))
        assert sorted(r["v"] for r in store.read("t").collect()) == [4, 8, 9]
    store.write("t", new.limit(0), "replace", ("k",))
    assert store.read("t").count() == 3
    store.write("t", spark.createDataFrame([("z", 1, "e")], "k string, v int, extra string"), "append")
    assert {r["extra"] for r in store.read("t").collect()} == {None, "e"}
    store.update("t", F.col("k") == "z", {"v": F.lit(7)})
    store.delete("t", F.col("k") == "y")
    assert sorted(r["v"] for r in store.read("t").collect()) == [7, 8, 9]
    with pytest.raises(ValueError):
        store.write("t", new, "merge")
    with pytest.raises(KeyError):
        store.read("none")
    store.create("empty", schema("review_decision"))
    assert store.read("empty").count() == 0 and len(store.read("empty").columns) == 32


def test_schemas(spark):
    df = spark.createDataFrame([("a", "1")], "cate_1_depth string, sc_measurement string")
    out = conform(df, schema("topic_pool"))
    assert out.columns == schema("topic_pool").names and out.first()["sc_measurement"] == 1
    with pytest.raises(ValueError):
        require(df, "memo")
    assert ensure(df, "x", 1).first()["x"] == 1 and ensure(df, "y", F.lit("q")).first()["y"] == "q"
    assert empty(spark, "topic_pool").count() == 0
    with pytest.raises(KeyError):
        Registry(spark).place("none")
    with pytest.raises(KeyError):
        Settings().updated({"nothing": 1})
    assert Settings().updated({"sampling": {"min_group_size": 5}}).sampling.min_group_size == 5


def test_samples_do_not_depend_on_partitions(spark, data):
    t = Tables(spark, data)
    m = sampling.dedupe_for_classification(t.memos, "detail_id")
    for f in (lambda d: sampling.group_sample(d, 3, "s"), lambda d: sampling.diverse_sample(d, 3, 10, "s"), lambda d: sampling.hash_order_sample(d, 2, "s")):
        ids = [sorted(r["memo_id"] for r in f(d).select("memo_id").collect()) for d in (m, m.repartition(7, "memo"))]
        assert ids[0] == ids[1]
    assert sampling.hash_order_sample(m, 0, "s").count() == m.count()


def test_expand_keeps_all_rows(spark, data):
    t = Tables(spark, data)
    detail = rows.latest(t.latest, [*GROUP, "memo_id"], ["is_latest", "created_at", "run_id"], ["detail_id"]).where("pred_topic_type = 'topic'")
    assert joins.expand(t.memos, detail).count() + joins.unmatched(t.memos, detail).count() == t.memos.count()


def test_shares_add_up(spark, data):
    s = report.summary(Tables(spark, data).detail)
    for r in s.groupBy(*GROUP, *VERSION).agg(F.sum("topic_ratio").alias("s"), F.sum("topic_cnt").alias("n"), F.max("total_cnt").alias("t")).collect():
        assert r["s"] == pytest.approx(1) and r["n"] == r["t"]


def test_overlay(spark):
    detail = spark.createDataFrame([("a", "b", 1, m, v, "t", "x", "topic", "s", 0.5, True, "why") for m in ("m1", "m2", "m3") for v in ("v1", "v2")], f"{G}, memo_id string, prompt_version string, taxonomy_version string, pred_topic string, pred_topic_type string, classification_stage string, confidence_score double, review_needed_yn boolean, match_reason string").withColumn("model_version", F.lit("m"))
    mk = lambda i, m, v, action, topic, at: (i, "a", "b", 1, m, v, "t", "m", "approved", action, topic, "who", at, at)
    dec = spark.createDataFrame([mk("1", "m1", "v1", "reassign_existing_topic", "new", "2024-01-01"), mk("2", "m1", "v1", "keep_others", None, "2024-02-01"), mk("3", "m2", "v2", "reassign_existing_topic", "new", "2024-01-01"), mk("4", "gone", "v1", "keep_others", None, "2024")], f"decision_id string, {G}, memo_id string, {V}, decision_status string, approved_action string, approved_topic string, reviewer string, reviewed_at string, created_at string")
    got = {(r["memo_id"], r["prompt_version"]): r for r in review.overlay(detail, dec).collect()}
    assert len(got) == 6
    assert got["m1", "v1"]["pred_topic"] == "기타" and got["m1", "v1"]["classification_stage"] == "human_fallback_keep_others"
    assert got["m2", "v2"]["pred_topic"] == "new" and got["m2", "v2"]["confidence_score"] == 1.0
    assert got["m2", "v1"]["pred_topic"] == "x" and got["m1", "v2"]["match_reason"] == "why"
    edits = spark.createDataFrame([("m1", "reassign_existing_topic", " ", "r", "")], "memo_id string, approved_action string, approved_topic string, reviewer string, review_comment string")
    with pytest.raises(ValueError):
        review.from_edits(detail, edits, "now")
    assert review.from_edits(detail, edits.withColumn("approved_topic", F.lit("q")), "now").count() == 2


def test_vectors(spark):
    data = [("g", "h", 1, "p", "t", "m", f"e{i}", "A" if i < 3 else "B", "enc", [1.0, 0.1 * i], 0.9) for i in range(5)] + [("g", "h", 1, "p", "t", "m", "z", "A", "enc", [0.0, 0.0], 0.9)]
    df = spark.createDataFrame(data, f"{G}, {V}, memo_id string, pred_topic string, embedding_model string, embedding array<float>, confidence_score double")
    p = vec.prototypes(df)
    assert [r["pred_topic"] for r in p.collect()] == ["A"]
    routed = vec.nearest(df, p, 0.82, 0.7, 3)
    got = {r["memo_id"]: r for r in routed.collect()}
    assert set(got) == {"e0", "e1", "e2", "e3", "e4"} and got["e0"]["prototype_route"] == "auto_accept"
    e = vec.evaluate(routed).first()
    assert e["accuracy"] == pytest.approx(0.6) and e["row_cnt"] == 5
    assert vec.confusion(routed).count() == 2


def test_pipeline_resumes(spark, store, data):
    raw = Tables(spark, data).raw.limit(200)
    s = Settings(run_id="r1", run_date="20240101")
    versions = dict.fromkeys(VERSION, "v1")
    t = Tables(spark, data)
    kw = {"profile": t.profile, "pool": t.pool, "settings": s, "versions": versions, "at": "2024-01-01T00:00:00Z", "min_size": 1}
    first = pipeline.classify_all(store, raw, model=boundary.RuleModel(), **kw)
    n = first.count()
    assert n > 0
    again = pipeline.classify_all(store, raw, **kw)
    assert again.count() == n  # nothing left to do
    full = pipeline.expand_all(store, raw, s, "now")
    assert full["full_rows"] + full["unmatched_raw_rows"] == full["raw_rows"]
    assert pipeline.summarise_all(store, s, "now").count() > 0
    enc = boundary.HashEncoder()
    added = pipeline.embed_new(store, s, enc, "now")
    assert added > 0 and pipeline.embed_new(store, s, enc, "now") == 0
    assert pipeline.attempts(lambda: 5) == 5
    bad = Store(spark, store.folder + "_bad")
    with pytest.raises(Exception):  # what stops the plan is no group's failure
        pipeline.classify_all(bad, raw, **{**kw, "profile": t.profile.withColumn("overall_sentiment_terms_json", F.raise_error(F.lit("boom")).cast("string"))})
    assert not bad.exists("pipeline_progress")


def test_one_group_fails_alone(spark, store):
    class Broken(boundary.RuleModel):
        """Fails for memos of one group, which name it."""

        def complete(self, system, user, options):
            if "broken" in user:
                raise ValueError("no answer")
            return super().complete(system, user, options)

    raw = spark.createDataFrame([("01. Sound", c, 1, f"{m} zzz {c}") for c in ("01-01. Fine", "01-02. broken") for m in ("a", "b")], f"{G}, memo string")
    raw = raw.withColumns({c: F.lit("1") for c in ("year", "country", "brand_name", "device_type")})
    names = raw.select(*GROUP).distinct()
    prof = names.withColumns({"overall_topic_name": F.lit("O"), **{f"{c}_json": F.lit('["x"]') for c in ("overall_sentiment_terms", "feature_hint_terms", "reason_signal_terms")}})
    kw = dict(profile=prof, pool=names.withColumns({"topic": F.lit("Topic"), "description": F.lit(""), "representative_memos_json": F.lit("[]")}), settings=Settings(run_id="r"), versions=dict.fromkeys(VERSION, "v"), at="now", model=Broken(), min_size=1, sleep=lambda _: None)
    key = pipeline.checkpoint_key("classification", kw["versions"], {})
    for turn in (1, 2, 3):
        out = pipeline.classify_all(store, raw, **kw).collect()
        assert {r["cate_2_depth"] for r in out} == {"01-01. Fine"} and len(out) == 2
        progress = store.read("pipeline_progress")
        assert [r["cate_2_depth"] for r in pipeline.done_groups(progress, key).collect()] == ["01-01. Fine"]
        assert [(r["cate_2_depth"], r["failed_cnt"]) for r in pipeline.failures(progress, key).collect()] == [("01-02. broken", min(turn, 2))]  # then it is given up
    causes = pipeline.failure_causes(progress, key).collect()
    assert len(causes) == 1 and "no answer" in causes[0]["cause"] and causes[0]["group_cnt"] == 1


def test_decisions_are_applied_to_their_groups_alone(spark, store):
    v = dict.fromkeys(VERSION, "v")
    rows_ = [("a", "b", 1, "m1", "x"), ("a", "b", 1, "m2", "y"), ("c", "d", 1, "m1", "z")]
    detail = spark.createDataFrame(rows_, f"{G}, memo_id string, pred_topic string").withColumns({**{k: F.lit(x) for k, x in v.items()}, "pred_topic_type": F.lit("others"), "run_id": F.lit("old")})
    store.write("classification_full", conform(detail, schema("classification_full")), "overwrite")
    decision = spark.createDataFrame([("1", "a", "b", 1, "m1", "reassign_existing_topic", "T"), ("2", "a", "b", 1, "m2", "keep_others", None)], f"decision_id string, {G}, memo_id string, approved_action string, approved_topic string")
    decision = decision.withColumns({**{k: F.lit(x) for k, x in v.items()}, "decision_status": F.lit("approved")})
    store.write("review_decision", conform(decision, schema("review_decision")), "overwrite")
    got = pipeline.apply_decisions(store, Settings(run_id="new"), "now")
    assert got == {"input_rows": 3, "approved_decisions": 2, "output_rows": 3, "reassigned_rows": 1, "kept_others_rows": 1}
    assert {(r["cate_1_depth"], r["memo_id"]): (r["pred_topic"], r["run_id"]) for r in store.read("classification_full").collect()} == {("a", "m1"): ("T", "new"), ("a", "m2"): ("기타", "new"), ("c", "m1"): ("z", "old")}


def test_decision_states_are_checked(spark):
    d = conform(spark.createDataFrame([("1", "pending"), ("2", "hold")], "decision_id string, decision_status string"), schema("review_decision"))
    out = {r["decision_id"]: r for r in review.updated(d, F.col("decision_id") == "1", "approved", "now", "keep_others", reviewer="me").collect()}
    assert (out["1"]["decision_status"], out["1"]["approved_action"], out["1"]["reviewer"]) == ("approved", "keep_others", "me") and out["2"]["decision_status"] == "hold"
    for bad in (("done",), ("approved", "now", "drop")):
        with pytest.raises(ValueError):
            review.updated(d, F.lit(True), bad[0], "now", bad[2] if len(bad) > 2 else "")


def test_appends_are_versions_of_their_own(spark, store, monkeypatch):
    df = lambda x: spark.createDataFrame([(x,)], "v int")
    store.write("t", df(1), "append")
    before = store.read("t")
    store.write("t", df(2), "append")
    assert before.count() == 1 and store.read("t").count() == 2
    monkeypatch.setattr("memoloom.sources.store.MOST_PARTS", 2)
    store.write("t", df(3), "append")
    assert sorted(r["v"] for r in store.read("t").collect()) == [1, 2, 3] and len(store._versions("t")[0]) == 1


def test_rows_and_frames_become_tables(spark):
    import pandas as pd

    from memoloom.schemas import from_pandas, from_rows

    rows_ = [{"cate_1_depth": "a", "cate_2_depth": None, "junk": 1}]
    assert [tuple(r) for r in from_rows(spark, rows_, "category_mapping").collect()] == [("a", None, None, None)]
    got = from_pandas(spark, pd.DataFrame({"sc_measurement": [1], "cate_1_depth": ["a"], "topic_order": [2], "topic": [float("nan")]}), "topic_pool").first()
    assert (got["sc_measurement"], got["topic_order"], got["topic"]) == (1, 2, None)


def test_merge_mapping_is_complete(spark):
    p = spark.createDataFrame([("a", "b", 1, 1, t, d) for t, d in (("Sound low", "x"), ("Sound bad", None), ("Overall good", ""), ("Other", "y"))], f"{G}, topic_order int, topic string, description string")
    target = F.lit("Overall good")
    lock = joins.locked_topic(F.col("source_topic"), F.col("_told"), target, ("praise",), ("vague",))
    got = {r["source_topic"]: r["merged_topic"] for r in joins.complete_mapping(p, boundary.merge_proposals(p, boundary.TermModel()), lock, target).collect()}
    assert got == {"Sound low": "Sound", "Sound bad": "Sound", "Overall good": "Overall good", "Other": "Other"}
    none = spark.createDataFrame([("a", "b", 1, "Nowhere", "X", "", "")], f"{G}, source_topic string, merged_topic string, merged_description string, merge_reason string")
    assert {r["source_topic"]: r["merged_topic"] for r in joins.complete_mapping(p, none).collect()} == {t: t for t in got}
    marks = spark.createDataFrame([("much praise", "a vague one"), ("much praise", "of sound"), ("Overall good", "")], "n string, d string")
    assert [r[0] for r in marks.select(joins.locked_topic(F.col("n"), F.col("d"), target, ("praise",), ("vague",))).collect()] == [True, False, True]


def test_known_seeds_are_not_asked_for(spark):
    samples = spark.createDataFrame([("a", "b", 1, "sound sound", 1), ("c", "d", 1, "remote works", 1)], f"{G}, memo string, prompt_rn int")
    known = spark.createDataFrame([("a", "b", 1, '["k"]')], f"{G}, feature_hint_terms_json string")
    got = {r["cate_1_depth"]: r for r in boundary.category_seeds(samples, boundary.TermModel(), known).collect()}
    assert got["a"]["is_known"] and got["a"]["feature_hint_terms_json"] == '["k"]'
    assert not got["c"]["is_known"] and "remote" in got["c"]["feature_hint_terms_json"]


def test_results_are_normalized(spark):
    df = spark.createDataFrame([(None, "topic", float("nan"), "[]", None), ("T", "topic", 1.0, '[{"topic":"T","score":1.0}]' , True)], "pred_topic string, pred_topic_type string, confidence_score double, candidate_topics_json string, llm_used_yn boolean")
    df = df.withColumns({"classification_stage": F.lit("x"), "match_reason": F.lit(None).cast("string"), "review_needed_yn": F.lit(None).cast("boolean")})
    a, b = cl.normalized(df, Settings(), {"prompt_version": "v"}, "now").collect()
    assert (a["pred_topic"], a["pred_topic_type"], a["confidence_score"], a["llm_used_yn"], a["review_needed_yn"]) == ("기타", "others", None, False, True)
    assert b["pred_topic_type"] == "topic" and "T" in b["candidate_topics_json"] and b["prompt_version"] == "v"


def test_listing_filters(spark):
    df = spark.createDataFrame([(1, "Alpha"), (2, "beta"), (3, None)], "k int, x string")
    assert [r["k"] for r in rows.matching(df, {"k": None, "x": " "}, {"x": "ALP"}).collect()] == [1]
    assert rows.matching(df, {"k": 2}).count() == 1
    assert tuple(rows.counted(df, F.col("x") == "beta").first()) == (3, 1)


def test_settings_file_and_command_line(spark, store, tmp_path, capsys):
    yaml = pytest.importorskip("yaml")
    from memoloom.__main__ import main
    from memoloom.config import load_settings

    path = tmp_path / "s.yaml"
    path.write_text(yaml.safe_dump({"sampling": {"min_group_size": 7}, "embedding": {"min_confidence": 0.0}}))
    s = load_settings(str(path), "2026-01-02")
    assert s.sampling.min_group_size == 7 and s.run_id == "run_20260102"
    d = spark.createDataFrame([("a", "b", 1, "m", "good sound", "T", "topic", "heuristic_topic_match", 0.1)], f"{G}, memo_id string, memo string, pred_topic string, pred_topic_type string, classification_stage string, confidence_score double")
    store.write("classification_detail", conform(d, schema("classification_detail")), "overwrite")
    assert main(["embed", store.folder, "--settings", str(path), "--run-date", "2026-01-02"]) == 0
    assert "1 new" in capsys.readouterr().out
    assert main(["embed", store.folder, "--run-date", "2026-01-02"]) == 0 and "0 new" in capsys.readouterr().out


def test_design(spark, store, data):
    raw = Tables(spark, data).raw
    s = Settings().updated({"sampling": {"min_group_size": 3}})
    left = pipeline.design_all(store, raw, boundary.TermModel(), s, dict.fromkeys(VERSION, "v"), "now", least=5)
    made = store.read("topic_pool")
    n = made.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), F.max("topic_count").alias("c"))
    assert n.count() > 0 and n.where("n <> c or n < 5 or n > 17").count() == 0
    assert left.join(n, list(GROUP), "left_semi").count() == 0
    assert n.count() + left.count() == store.read("rule_profile").count()


def test_steps_on_the_way_are_not_done(spark):
    rows_ = [("k", "p", "a", "b", 1, "rule_profile_done", "completed"), ("k", "p", "c", "d", 1, "group_done", "completed"), ("k", "p", "e", "f", 1, "group_failed", "failed"), ("k", "p", "e", "f", 1, "group_failed", "failed")]
    progress = spark.createDataFrame(rows_, f"checkpoint_key string, pipeline_name string, {G}, step string, status string")
    g = spark.createDataFrame([("a", "b", 1), ("c", "d", 1), ("e", "f", 1)], G)
    assert [tuple(r) for r in pipeline.open_groups(g, progress, "k", 2).collect()] == [("a", "b", 1)]


def test_stream(spark, store, tmp_path):
    from memoloom.streaming.incremental import classify_stream

    src = str(tmp_path / "in")
    raw = groups(spark).crossJoin(spark.createDataFrame([("great remote",), ("battery died",)], "memo string")).withColumns({c: F.lit("1") for c in ("year", "country", "brand_name", "device_type")})
    raw.write.parquet(src)
    for _ in range(2):
        classify_stream(spark, src, raw.schema, dims.profiles(profile(spark)), dims.topics(pool(spark)), store, str(tmp_path / "cp")).awaitTermination()
    assert store.read("classification_stream").count() == 2


def test_eligible(spark):
    df = spark.createDataFrame([("a", "b", 1, "x"), ("***", "b", 1, "x"), (None, None, -1, "x"), ("a", "b", 0, "x"), ("a", "b", 1, " "), ("a", "b", 1, None)], f"{G}, memo string")
    assert eligible(df).count() == 2
    assert eligible(df, group={"cate_1_depth": "a", "cate_2_depth": "*"}).count() == 1
    assert "memo_id" in with_memo_id(df).columns
