"""Language models and encoders behind small protocols; the stand-ins are deterministic.

Only rows that nothing else resolves cross into Python, in Arrow batches on the executors.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .config import OVERALL_TOPIC, Classifying
from .functions.identity import GROUP


class TextModel(Protocol):
    def complete(self, system: str, user: str, options: dict[str, Any]) -> str: ...


class Encoder(Protocol):
    name: str
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class HashEncoder:
    """Vectors of unit length from hashed words; equal texts have equal vectors, on any machine."""

    name: str = "hash-encoder-64"
    dim: int = 64

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for i, t in enumerate(texts):
            for w in (t or "").lower().split():
                h = hashlib.md5(w.encode()).digest()
                out[i, h[0] % self.dim] += 1.0 if h[1] & 128 else -1.0
        return out / np.linalg.norm(out, axis=1, keepdims=True).clip(1e-9)


@dataclass(frozen=True)
class RuleModel:
    """Stands in for a language model: picks the candidate whose name shares most letters with the memo."""

    def complete(self, system: str, user: str, options: dict[str, Any]) -> str:
        ask = json.loads(user)
        memo = set(ask["memo"].lower())
        best = max(ask["candidates"], key=lambda t: (len(memo & set(t.lower())), t), default=None)
        kind = "overall" if best == ask.get("overall") else "topic"
        return json.dumps({"pred_topic": best, "pred_topic_type": kind, "match_reason": f"closest name {best}"} if best else {"pred_topic": "", "pred_topic_type": "others", "match_reason": "no candidate"}, ensure_ascii=False)


@dataclass(frozen=True)
class TermModel:
    """Stands in for a language model that designs a taxonomy: terms and topics are a group's frequent words."""

    terms: int = 12

    def complete(self, system: str, user: str, options: dict[str, Any]) -> str:
        ask = json.loads(user)
        if ask["task"] == "merge":  # topics of one first word are one, as long as that makes few enough
            return json.dumps({"rows": [{"source_topic": t["topic"], "merged_topic": t["topic"].split(" ")[0], "merged_description": t["description"], "merge_reason": "first word"} for t in ask["topics"]]}, ensure_ascii=False)
        counts: dict[str, int] = {}
        for memo in ask["memos"]:
            for w in set(re.findall(r"[^\W\d_]{4,}", memo.lower())):
                counts[w] = counts.get(w, 0) + 1
        best = sorted(counts, key=lambda w: (-counts[w], w))[: self.terms]
        if ask["task"] == "category seed":
            return json.dumps({"category_summary": " ".join(best[:3]), "feature_hint_terms": best, "candidate_topic_labels": best[:5], "sample_non_overall_memos": ask["memos"][:2]}, ensure_ascii=False)
        if ask["task"] == "profile":
            return json.dumps({"overall_sentiment_terms": best[:2], "feature_hint_terms": best, "reason_signal_terms": best[-1:], "non_overall_examples": ask["memos"][:3]}, ensure_ascii=False)
        topics = [{"topic": w, "description": f"memos about {w}", "representative_memos": [m for m in ask["memos"] if w in m.lower()][:2]} for w in best]
        return json.dumps({"topics": topics}, ensure_ascii=False)


_FENCE = re.compile(r"^\s*```[a-zA-Z]*\s*|\s*```\s*$")


def loose_json(text: str) -> Any:
    """JSON out of a model's answer: fenced, named, with text around it or with commas before closing brackets."""
    body = _FENCE.sub("", text.strip())
    body = re.sub(r"^\s*json\b", "", body, flags=re.I)
    ends = [(body.find(a), body.rfind(b)) for a, b in ("{}", "[]") if a in body and b in body]
    if ends:
        start, stop = min(ends)
        body = body[start : stop + 1]
    try:
        return json.loads(body)
    except ValueError:
        return json.loads(re.sub(r",(\s*[}\]])", r"\1", body))


def inference_options(config: dict[str, Any]) -> dict[str, Any]:
    """The options to send; with ``top_p`` there is no ``temperature``."""
    out = {k: config[k] for k in ("max_tokens", "top_p", "temperature", "stop") if config.get(k) is not None}
    if "top_p" in out:
        out.pop("temperature", None)
    return out


def with_retry(call: Callable[[], Any], attempts: int = 3, base: float = 1.8, sleep: Callable[[float], None] = time.sleep) -> Any:
    """The call's result; after each failure a pause of ``base`` to the number of attempts; RuntimeError at last."""
    last: Exception | None = None
    for n in range(1, attempts + 1):
        try:
            return call()
        except Exception as e:  # noqa: BLE001
            last = e
            if n < attempts:
                sleep(base**n)
    raise RuntimeError(f"failed {attempts} times: {last}") from last


def complete_json(model: TextModel, system: str, user: str, options: dict[str, Any] | None = None, attempts: int = 3, sleep: Callable[[float], None] = time.sleep) -> Any:
    return with_retry(lambda: loose_json(model.complete(system, user, options or {})), attempts, sleep=sleep)


def checked(answer: Any, valid: list[str], overall: str | None, others: str) -> tuple[str, str, str, bool]:
    """(topic, type, reason, review) of an answer: what isn't a known topic or type becomes ``others``."""
    a = answer if isinstance(answer, dict) else {}
    topic, kind, why = (str(a.get(k) or "").strip() for k in ("pred_topic", "pred_topic_type", "match_reason"))
    if overall and topic == overall:
        return topic, "overall", why, False
    if topic == others or kind == "others" or not topic:
        return others, "others", why, True
    if topic not in valid:
        return others, "others", "llm_returned_unknown_topic", True
    return topic, kind if kind in ("topic", "ambiguous") else "topic", why, False


def model_fallback(df: DataFrame, topics: DataFrame, model: TextModel, c: Classifying = Classifying(), sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Asks the model about rows that stayed ambiguous or without a topic; all others pass by in the JVM.

    A request that fails for good gives no error but a row of the stage ``llm_error``, without a topic, with the cause
    as its reason; so one group's failure doesn't touch another's rows.
    """
    names = topics.groupBy(*GROUP).agg(F.sort_array(F.collect_set("topic")).alias("_topics"))
    open_ = F.col("pred_topic_type").isin("ambiguous", "others")
    rest, ask = df.where(~open_), df.where(open_).join(names, list(GROUP), "left")
    fields = df.schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for memo, known, sc in zip(b["memo"], b["_topics"], b["sc_measurement"]):
                valid = [] if known is None else list(known)
                overall = OVERALL_TOPIC.get(sc, OVERALL_TOPIC[0])
                user = json.dumps({"memo": memo or "", "candidates": valid, "overall": overall}, ensure_ascii=False)
                try:
                    rows.append((*checked(complete_json(model, "Choose one topic.", user, sleep=sleep), valid, overall, c.others_label), "llm_fallback"))
                except RuntimeError as e:
                    rows.append((c.others_label, "others", str(e), True, "llm_error"))
            out = b.drop(columns="_topics")
            for i, k in enumerate(("pred_topic", "pred_topic_type", "match_reason", "review_needed_yn", "classification_stage")):
                out[k] = [r[i] for r in rows]
            out["confidence_score"], out["llm_used_yn"] = None, True
            yield out[fields.names]

    return rest.unionByName(ask.mapInPandas(run, fields))


def encode(df: DataFrame, encoder: Encoder, text: str = "memo", batch: int = 64) -> DataFrame:
    """Adds text, vector, model, length and whether it is of unit length; texts never come to the driver."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField("embedding_text", T.StringType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("embedding_model", T.StringType()), T.StructField("embedding_dim", T.IntegerType()), T.StructField("embedding_normalized", T.BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = ["" if t is None else t for t in b[text]]
            vectors = [v for a in range(0, len(texts), batch) for v in encoder.encode(texts[a : a + batch])]
            yield b.assign(embedding_text=texts, embedding=vectors, embedding_model=encoder.name, embedding_dim=encoder.dim, embedding_normalized=True)

    return df.mapInPandas(run, schema)


def topic_pool_rows(answer: list[dict[str, Any]], overall: str, least: int, most: int) -> list[dict[str, Any]]:
    """Topics of an answer, without those that repeat a name, the overall one first; ValueError out of bounds."""
    seen, out = {overall.lower()}, [{"topic": overall, "description": "", "representative_memos": []}]
    for row in answer:
        name = str(row.get("topic") or "").strip()
        if name and name.lower() not in seen and len(out) < most:
            seen.add(name.lower())
            out.append({"topic": name, "description": str(row.get("description") or ""), "representative_memos": [str(m) for m in row.get("representative_memos") or []][:10]})
    if len(out) < least:
        raise ValueError(f"{len(out)} topics, fewer than {least}")
    return out


# How many terms of each list are stored.
PROFILE_CAPS = {"overall_sentiment_terms": 40, "feature_hint_terms": 100, "reason_signal_terms": 100, "non_overall_examples": 20}
SEED_CAPS = {"feature_hint_terms": 80, "reason_signal_terms": 80, "overall_sentiment_terms": 40, "candidate_topic_labels": 20, "sample_non_overall_memos": 12}


def listed_terms(answer: dict[str, Any], caps: dict[str, int]) -> dict[str, list[str]]:
    """Term lists of an answer, cleaned, without repeats that differ in case alone, each cut to its cap."""
    out = {}
    for key, most in caps.items():
        seen: dict[str, str] = {}
        for t in answer.get(key) or []:
            t = " ".join(str(t).split())
            if t:
                seen.setdefault(t.lower(), t)
        out[key] = list(seen.values())[:most]
    return out


def profile_terms(answer: dict[str, Any]) -> dict[str, list[str]]:
    return listed_terms(answer, PROFILE_CAPS)


def category_seeds(samples: DataFrame, model: TextModel, known: DataFrame | None = None) -> DataFrame:
    """Terms that a category starts from, one row a group: those of ``known`` (group columns and the ``..._json``
    columns returned here) where it has the group, else what the model says of the group's samples."""
    ask = samples if known is None else samples.join(known.select(*GROUP), list(GROUP), "left_anti")

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        memos = b.sort_values("prompt_rn")["memo"].tolist()
        answer = complete_json(model, *prompt("category seed", key, memos))
        row = dict(zip(GROUP, key)) | {"category_summary": " ".join(str(answer.get("category_summary") or "").split()), "is_known": False}
        return pd.DataFrame([row | {f"{k}_json": json.dumps(v, ensure_ascii=False) for k, v in listed_terms(answer, SEED_CAPS).items()}])

    lists = [f"{k}_json" for k in SEED_CAPS]
    made = ask.groupBy(*GROUP).applyInPandas(run, f"cate_1_depth string, cate_2_depth string, sc_measurement int, category_summary string, is_known boolean, {', '.join(f'{c} string' for c in lists)}")
    if known is None:
        return made
    have = known.select(*GROUP, *[F.col(c) if c in known.columns else F.lit(None).cast("string").alias(c) for c in ("category_summary", *lists)])
    return made.unionByName(have.withColumn("is_known", F.lit(True)))


def reference_topics(topics: DataFrame, hints: int = 15, memos: int = 3) -> DataFrame:
    """What a request says of each topic besides its name: description, hints and a few memos, as JSON; one row a group."""
    entry = F.struct("topic", "description", F.slice("hints", 1, hints).alias("hints"), F.slice("memos", 1, memos).alias("memos"))
    return topics.groupBy(*GROUP).agg(F.to_json(F.sort_array(F.collect_list(entry))).alias("reference_json"))


def overall_examples(terms: DataFrame, targets: int = 6, sentiments: int = 5, most: int = 20) -> DataFrame:
    """Examples of bare approval for a request: the group's sentiment terms before its own names, and alone."""
    names = F.slice(F.filter("neutral", lambda t: F.length(t) >= 2), 1, targets)
    said = F.slice("overall_sentiment_terms", 1, sentiments)
    both = F.flatten(F.transform(names, lambda t: F.transform(said, lambda s: F.concat(s, F.lit(" "), t))))
    return terms.select(*GROUP, F.slice(F.array_distinct(F.concat(both, said)), 1, most).alias("examples"))


def merge_proposals(pool: DataFrame, model: TextModel) -> DataFrame:
    """Larger topics that a model proposes for those of each group, at most half as many (two at least).

    One request a group, whose topics are few by construction. A group whose request fails gives no rows, so that
    its topics stay themselves; see :func:`memoloom.operators.joins.complete_mapping`.
    """
    columns = [*GROUP, "source_topic", "merged_topic", "merged_description", "merge_reason"]

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        topics = b.sort_values(["topic_order", "topic"])
        names = [str(t) for t in topics["topic"]]
        try:
            told = [str(t or "") for t in topics["description"]]
            answer = complete_json(model, *prompt("merge", key, [], topics=[{"topic": n, "description": d} for n, d in zip(names, told)], max_groups=max(2, len(names) // 2)))
            rows = answer.get("rows") or []
        except RuntimeError:
            rows = []
        text = lambda r, k: " ".join(str(r.get(k) or "").split())
        return pd.DataFrame([(*key, *(text(r, k) for k in columns[3:])) for r in rows if isinstance(r, dict)], columns=columns)

    return pool.where("topic is not null").groupBy(*GROUP).applyInPandas(run, "cate_1_depth string, cate_2_depth string, sc_measurement int, source_topic string, merged_topic string, merged_description string, merge_reason string")


def prompt(task: str, group: tuple, memos: list[str], **more: Any) -> tuple[str, str]:
    """Instruction and payload of a request about one group."""
    return f"Design a {task} for one group of reviews. Answer in JSON.", json.dumps({"task": task, "group": list(map(str, group)), "memos": memos, **more}, ensure_ascii=False)


def design_profiles(samples: DataFrame, model: TextModel) -> DataFrame:
    """A rule profile of each group from its sampled memos (``memo``, ``prompt_rn``), one request a group.

    Samples are small by construction (some hundred memos a group), so a group fits a task.
    """

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        memos = b.sort_values("prompt_rn")["memo"].tolist()
        terms = profile_terms(complete_json(model, *prompt("profile", key, memos)))
        row = dict(zip(GROUP, key)) | {"overall_topic_name": OVERALL_TOPIC.get(key[2], OVERALL_TOPIC[0])} | {f"{k}_json": json.dumps(v, ensure_ascii=False) for k, v in terms.items()}
        return pd.DataFrame([row])

    columns = "overall_topic_name string, overall_sentiment_terms_json string, feature_hint_terms_json string, reason_signal_terms_json string, non_overall_examples_json string"
    return samples.groupBy(*GROUP).applyInPandas(run, f"cate_1_depth string, cate_2_depth string, sc_measurement int, {columns}")


def design_pools(samples: DataFrame, model: TextModel, least: int = 7, most: int = 17) -> DataFrame:
    """Topics of each group, the overall one first; a group whose answer stays out of bounds gives no rows but
    the reason, in ``error``."""

    def run(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        memos = b.sort_values("prompt_rn")["memo"].tolist()
        try:
            answer = complete_json(model, *prompt("topics", key, memos, min_topics=least, max_topics=most))
            rows = topic_pool_rows(answer.get("topics") or [], OVERALL_TOPIC.get(key[2], OVERALL_TOPIC[0]), least, most)
            out = [(*key, i, r["topic"], r["description"], json.dumps(r["representative_memos"], ensure_ascii=False), len(rows), None) for i, r in enumerate(rows, 1)]
        except (ValueError, RuntimeError) as e:
            out = [(*key, None, None, None, None, 0, str(e))]
        return pd.DataFrame(out, columns=[*GROUP, "topic_order", "topic", "description", "representative_memos_json", "topic_count", "error"])

    return samples.groupBy(*GROUP).applyInPandas(run, "cate_1_depth string, cate_2_depth string, sc_measurement int, topic_order int, topic string, description string, representative_memos_json string, topic_count int, error string")
