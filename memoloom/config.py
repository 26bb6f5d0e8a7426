"""Settings with their defaults; time and run id are parameters, never read from the clock."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any


# Names, states and numbers that stored tables and their readers share.
OVERALL_TOPIC = {1: "전반적 긍정", -1: "전반적 부정", 0: "전반적 평가"}
RULE_STAGES = ("rule_overall", "rule_overall_target_sentiment")
WEIGHTS = {"name": 1.20, "description": 0.85, "memos": 0.05, "feature_in_name": 1.25, "feature_in_description": 0.85, "hint_of_words": 2.0, "hint": 1.4}
RULE_CONFIDENCE, REASON_SCORE = 0.99, 9.0
DECISION_STATUSES = ("pending", "approved", "rejected", "hold")
DECISION_ACTIONS = ("reassign_existing_topic", "keep_others", "create_new_topic", "revise_topic_pool")


@dataclass(frozen=True)
class Sampling:
    min_group_size: int = 100
    max_sample_rows: int = 1000
    max_rule_sample_rows: int = 800
    max_prompt_rows: int = 200
    excluded_prefix: str = "***"
    sentiments: tuple[int, ...] = (1, -1)
    design_seed: str = "seed_20260420"
    classify_seed: str = "seed_20260707"


@dataclass(frozen=True)
class Classifying:
    max_rows_per_group: int = 1000
    overall_max_text_length: int = 40
    min_score: float = 0.35
    min_margin: float = 0.08
    shortlist: int = 5
    others_label: str = "기타"
    review_default: bool = True


@dataclass(frozen=True)
class Reporting:
    others_min_count: int = 5
    others_min_ratio: float = 0.01
    refine_min_count: int = 5
    refine_min_distinct: int = 1
    refine_min_ratio: float = 0.02
    max_rows: int = 200


@dataclass(frozen=True)
class Embedding:
    model: str = "stub-encoder-64"
    dim: int = 64
    batch: int = 64
    min_confidence: float = 0.6
    label_types: tuple[str, ...] = ("topic", "overall")
    min_memos: int = 3
    auto_accept: float = 0.82
    fallback: float = 0.70
    top_k: int = 3


@dataclass(frozen=True)
class Settings:
    run_id: str = "run"
    run_date: str = "19700101"
    sampling: Sampling = field(default_factory=Sampling)
    classifying: Classifying = field(default_factory=Classifying)
    reporting: Reporting = field(default_factory=Reporting)
    embedding: Embedding = field(default_factory=Embedding)
    source_filters: tuple[str, ...] = ()
    max_failed_retries: int = 2

    def updated(self, values: dict[str, Any]) -> Settings:
        """A copy with nested values replaced; an unknown name raises KeyError."""
        return _updated(self, values)


def _updated(part: Any, values: dict[str, Any]) -> Any:
    known = {f.name for f in fields(part)}
    if missing := set(values) - known:
        raise KeyError(f"unknown settings: {sorted(missing)}")
    new = {}
    for k, v in values.items():
        old = getattr(part, k)
        new[k] = _updated(old, v) if is_dataclass(old) and isinstance(v, dict) else (tuple(v) if isinstance(old, tuple) else v)
    return replace(part, **new)


def load_settings(path: str, run_date: str, prefix: str = "run") -> Settings:
    """Settings of a YAML file (needs PyYAML); run id is ``prefix_YYYYMMDD``."""
    import yaml

    with open(path, encoding="utf-8") as f:
        values = yaml.safe_load(f) or {}
    return Settings().updated(values | {"run_date": run_date, "run_id": f"{prefix}_{run_date.replace('-', '')}"})
