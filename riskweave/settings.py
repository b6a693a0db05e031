"""Fixed values of the risk model and the tunable settings of the jobs."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# Country and merchant-category risk, used by every rule profile but ``job``.
COUNTRY_RISK = {
    "US": 0.1, "UK": 0.1, "CA": 0.1, "DE": 0.15, "FR": 0.15, "JP": 0.1, "AU": 0.1,
    "NZ": 0.1, "CH": 0.1, "SE": 0.1, "BR": 0.4, "MX": 0.4, "IN": 0.35, "CN": 0.4,
    "RU": 0.5, "TR": 0.45, "ZA": 0.4, "AE": 0.35, "NG": 0.8, "UA": 0.7, "PK": 0.65,
    "VN": 0.6, "PH": 0.55, "ID": 0.5, "KE": 0.65, "GH": 0.7, "UNKNOWN": 0.9,
}
CATEGORY_RISK = {
    "grocery": 0.1, "retail": 0.15, "restaurant": 0.15, "utilities": 0.1,
    "healthcare": 0.1, "education": 0.1, "electronics": 0.35, "travel": 0.4,
    "hotel": 0.35, "entertainment": 0.3, "subscription": 0.25, "gambling": 0.85,
    "crypto": 0.9, "jewelry": 0.7, "luxury": 0.65, "adult": 0.8,
    "wire_transfer": 0.75, "unknown": 0.5,
}
# Risk lists of the rule profile ``job``.
JOB_COUNTRY_RISK = {
    "US": 0.2, "UK": 0.2, "CA": 0.2, "DE": 0.3, "FR": 0.3,
    "NG": 0.9, "RU": 0.8, "CN": 0.6, "IN": 0.4, "BR": 0.5,
}
JOB_CATEGORY_RISK = {
    "grocery": 0.1, "restaurant": 0.2, "retail": 0.3, "electronics": 0.5,
    "jewelry": 0.7, "gambling": 0.9, "cryptocurrency": 0.95, "travel": 0.4,
    "entertainment": 0.3,
}
# Merchants that are always reported.
BLACKLISTED_MERCHANTS = ("MERCHANT_999", "MERCHANT_998", "MERCHANT_997")

# Amount buckets of the dashboard (half open) with their labels, and the
# upper bounds of the metric histograms in seconds or score points.
AMOUNT_BUCKETS = (
    (0, 100, "$0-100"), (100, 500, "$100-500"), (500, 1000, "$500-1K"),
    (1000, 5000, "$1K-5K"), (5000, 10000, "$5K-10K"), (10000, 100000, "$10K+"),
)
PROCESSING_LATENCY_BOUNDS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0)
E2E_LATENCY_BOUNDS = (0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 120.0)
SCORE_BOUNDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)

# Seconds reported for the first transaction of a user (fixed value).
NO_PREVIOUS_SECONDS = 999999


@dataclass(frozen=True)
class Settings:
    """Job settings; ``from_env`` overrides any field by its upper-case name."""

    kafka_bootstrap_servers: str = "localhost:9092"
    kafka_topic_transactions: str = "transactions"
    kafka_topic_fraud_alerts: str = "fraud-alerts"
    kafka_consumer_group: str = "risk-scoring"
    # Records of one trigger; sized by what the cluster handles in a trigger interval.
    max_offsets_per_trigger: int = 500_000
    fail_on_data_loss: bool = True
    trigger_interval: str = "5 seconds"
    watermark_delay: str = "30 seconds"
    window_duration: str = "1 minute"
    window_slide: str = "30 seconds"
    dedup_window: str = "300 seconds"
    mongodb_uri: str = "mongodb://localhost:27017"
    mongodb_database: str = "transaction_risk"
    realtime_ttl_seconds: int = 3600
    # A user without a transaction for so long leaves the state of current risk scores.
    user_idle_seconds: int = 86_400
    fraud_threshold: float = 0.7
    velocity_window_seconds: int = 300
    # Width of the time slices a user's history is cut into before windowing. Narrower
    # slices spread a hot user further; wider ones make fewer summary rows for the others.
    history_slice_seconds: int = 900
    high_amount: float = 1000.0
    very_high_amount: float = 5000.0
    train_share: float = 0.8
    min_training_rows: int = 100
    max_iter: int = 100
    reg_param: float = 0.01

    @classmethod
    def from_env(cls) -> "Settings":
        overrides = {}
        for field in fields(cls):
            raw = os.environ.get(field.name.upper())
            if raw is not None:
                kind = type(field.default)
                overrides[field.name] = raw.lower() in ("1", "true", "yes") if (
                    kind is bool) else kind(raw)
        return cls(**overrides)


DEFAULTS = Settings()
