"""Rule profiles: declarative weights turned into one Spark expression.

A profile lists terms; ``score_column`` folds them into a single sum that stays inside
generated code. Every term yields a non-null number, so the clamp never sees a null.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.operators.enrich import add_risk, add_risk_as_of, category_risk, country_risk
from riskweave.settings import (
    CATEGORY_RISK, COUNTRY_RISK, JOB_CATEGORY_RISK, JOB_COUNTRY_RISK,
)

COUNTRY_WEIGHT = 0.25
CATEGORY_WEIGHT = 0.20


@dataclass(frozen=True)
class Above:
    """Weight of the highest bound that ``column`` exceeds (strictly)."""

    column: str
    tiers: tuple[tuple[float, float], ...]

    def expr(self) -> Column:
        out = None
        for bound, weight in sorted(self.tiers, reverse=True):
            hit = F.col(self.column) > bound
            value = F.lit(weight)
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out.otherwise(F.lit(0.0))

    def sql(self) -> str:
        cases = "".join(f" WHEN {self.column} > {bound}D THEN {weight}D"
                        for bound, weight in sorted(self.tiers, reverse=True))
        return f"CASE{cases} ELSE 0D END"


@dataclass(frozen=True)
class IsTrue:
    column: str
    weight: float

    def expr(self) -> Column:
        return F.when(F.col(self.column), F.lit(self.weight)).otherwise(F.lit(0.0))

    def sql(self) -> str:
        return f"IF(coalesce({self.column}, false), {self.weight}D, 0D)"


@dataclass(frozen=True)
class Within:
    """Weight when ``column`` lies in the closed range."""

    column: str
    low: int
    high: int
    weight: float

    def expr(self) -> Column:
        inside = F.col(self.column).between(self.low, self.high)
        return F.when(inside, F.lit(self.weight)).otherwise(F.lit(0.0))

    def sql(self) -> str:
        inside = f"{self.column} BETWEEN {self.low} AND {self.high}"
        return f"IF(coalesce({inside}, false), {self.weight}D, 0D)"


@dataclass(frozen=True)
class Profile:
    name: str
    terms: tuple
    threshold: float
    unknown_country: float
    # Differs from ``unknown_country`` only where an absent country counts as UNKNOWN.
    null_country: float | None = None
    unknown_category: float = 0.5
    countries: dict = field(default_factory=lambda: COUNTRY_RISK)
    categories: dict = field(default_factory=lambda: CATEGORY_RISK)

    def country_default(self) -> Column:
        if self.null_country is None:
            return F.lit(self.unknown_country)
        return (
            F.when(F.col("country").isNull(), F.lit(self.null_country))
            .otherwise(F.lit(self.unknown_country))
        )


# Weights, bounds and thresholds of the seven rule profiles.
AMOUNT_TIERS = Above("amount", ((1000, 0.10), (5000, 0.20)))
NIGHT = Within("hour_of_day", 0, 5, 0.10)
ONLINE = IsTrue("is_online", 0.10)
KNOWN_FRAUD = IsTrue("is_fraud", 0.15)
PROFILES = {
    "batch": Profile(
        "batch",
        (
            Above("amount_zscore", ((2, 0.10), (3, 0.20))),
            Above("velocity_count", ((5, 0.15),)),
            Above("velocity_amount", ((5000.0, 0.10),)),
            IsTrue("is_online", 0.05),
            Within("hour_of_day", 0, 5, 0.05),
        ),
        threshold=0.7, unknown_country=0.9,
    ),
    "stream": Profile(
        "stream", (AMOUNT_TIERS, ONLINE, NIGHT, Above("velocity_flag", ((0.0, 0.15),))),
        threshold=0.7, unknown_country=0.9,
    ),
    "sql": Profile(
        "sql", (AMOUNT_TIERS, ONLINE, NIGHT, KNOWN_FRAUD),
        threshold=0.6, unknown_country=0.5,
    ),
    "job": Profile(
        "job", (AMOUNT_TIERS, ONLINE, NIGHT, KNOWN_FRAUD),
        threshold=0.6, unknown_country=0.5,
        countries=JOB_COUNTRY_RISK, categories=JOB_CATEGORY_RISK,
    ),
    "processor": Profile(
        "processor", (AMOUNT_TIERS, ONLINE, NIGHT, KNOWN_FRAUD),
        threshold=0.6, unknown_country=0.5,
    ),
    "simple": Profile(
        "simple", (AMOUNT_TIERS, ONLINE, NIGHT, KNOWN_FRAUD),
        threshold=0.6, unknown_country=0.5, null_country=0.9,
    ),
    "scorer": Profile(
        "scorer", (AMOUNT_TIERS, ONLINE, NIGHT, Above("velocity_count", ((5, 0.15),))),
        threshold=0.7, unknown_country=0.9,
    ),
}


def profile(name: str, threshold: float | None = None) -> Profile:
    found = PROFILES[name]
    return found if threshold is None else replace(found, threshold=threshold)


def score_column(rules: Profile, columns: list[str],
                 absent: tuple[str, ...] = ()) -> Column:
    """Clamped sum of the two weighted risks and of all terms.

    A term counts as zero only if its input is named in ``absent``; an input that is
    missing otherwise is an error, as it would lower every score unseen.
    """
    missing = {t.column for t in rules.terms} - set(columns) - set(absent)
    if missing:
        raise ValueError(f"profile {rules.name} needs {', '.join(sorted(missing))}")
    parts = [
        F.col("country_risk") * COUNTRY_WEIGHT,
        F.col("merchant_risk") * CATEGORY_WEIGHT,
        *[t.expr() for t in rules.terms if t.column in columns],
    ]
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), reduce(add, parts)))


def add_velocity_flag(df: DataFrame, high_amount: float = 1000.0) -> DataFrame:
    """Per-row stand-in for velocity, usable where no history is at hand."""
    flag = F.when(F.col("amount") > high_amount, F.lit(1.0)).otherwise(F.lit(0.0))
    return df.withColumn("velocity_flag", flag)


def score(df: DataFrame, rules: Profile | str, country_table: DataFrame | None = None,
          category_table: DataFrame | None = None, absent: tuple[str, ...] = (),
          high_amount: float = 1000.0, versions: DataFrame | None = None) -> DataFrame:
    """Add both risks, ``fraud_score`` and ``is_fraud_predicted``.

    Risks, scores and flags of an earlier scoring are replaced: every profile has its own
    tables and defaults. ``absent`` names inputs that the frame lacks and that count as
    zero. The frame may be a stream. ``versions`` are risk tables by time, in place of the
    two tables.
    """
    rules = profile(rules) if isinstance(rules, str) else rules
    spark = df.sparkSession
    if rules.name == "stream":
        df = add_velocity_flag(df, high_amount)
    df = df.drop("country_risk", "merchant_risk")
    df = add_risk_as_of(
        df, versions, rules.country_default(), rules.unknown_category,
    ) if versions is not None else add_risk(
        df,
        country_risk(spark, rules.countries) if country_table is None else country_table,
        category_risk(spark, rules.categories) if category_table is None else category_table,
        rules.country_default(), rules.unknown_category,
    )
    return df.withColumn("fraud_score", score_column(rules, df.columns, absent)).withColumn(
        "is_fraud_predicted", F.col("fraud_score") >= rules.threshold
    )


def score_features(df: DataFrame) -> DataFrame:
    """The six inputs of the ``scorer`` profile as one nested column."""
    def level(term) -> Column:
        return term.expr() if term.column in df.columns else F.lit(0.0)

    return df.withColumn("features", F.struct(
        F.col("country_risk"),
        F.col("merchant_risk"),
        level(Above("amount", ((1000, 0.5), (5000, 1.0)))).alias("amount_risk"),
        level(IsTrue("is_online", 1.0)).alias("is_online"),
        level(Within("hour_of_day", 0, 5, 1.0)).alias("hour_risk"),
        level(Above("velocity_count", ((5, 1.0),))).alias("velocity_risk"),
    ))


def amount_flags(df: DataFrame, high: float = 1000.0, very_high: float = 5000.0) -> DataFrame:
    return df.withColumns({
        "is_high_amount": F.col("amount") > high,
        "is_very_high_amount": F.col("amount") > very_high,
    })


SCORE_INPUTS = {"amount": "DOUBLE", "country_risk": "DOUBLE", "merchant_risk": "DOUBLE",
                "is_online": "BOOLEAN", "hour_of_day": "INT", "velocity_flag": "DOUBLE"}


def register_score_function(spark, name: str = "risk_score", rules: str = "stream") -> None:
    """SQL form of a profile for SQL users: its own terms as an inlined SQL function, no
    Python worker. A missing risk counts as an unknown country or category."""
    chosen = PROFILES[rules]
    inputs = ", ".join(f"{column} {kind}" for column, kind in SCORE_INPUTS.items())
    terms = "".join(f"\n            + {t.sql()}" for t in chosen.terms)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({inputs})
        RETURNS DOUBLE
        RETURN least(1D, greatest(0D,
            coalesce(country_risk, {chosen.unknown_country}D) * {COUNTRY_WEIGHT}D
            + coalesce(merchant_risk, {chosen.unknown_category}D) * {CATEGORY_WEIGHT}D{terms}))
    """)
