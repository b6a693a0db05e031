from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskweave.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture()
def make_txns(spark):
    """Transactions from partial rows; times are given in seconds since the epoch."""
    columns = {
        "transaction_id": "string", "user_id": "string", "amount": "double",
        "merchant_id": "string", "merchant_category": "string", "country": "string",
        "is_online": "boolean", "hour_of_day": "int", "_label": "string",
        "event_s": "double", "proc_s": "double",
    }
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())

    def make(rows: list[dict]):
        data = []
        for i, row in enumerate(rows):
            full = {"transaction_id": f"T{i}", "user_id": "U", "amount": 10.0,
                    "merchant_id": "M", "_label": "normal", "event_s": float(i), **row}
            full.setdefault("proc_s", full["event_s"])
            data.append(tuple(full.get(c) for c in columns))
        df = spark.createDataFrame(data, schema)
        return df.selectExpr(
            "* except (event_s, proc_s)",
            "timestamp_seconds(event_s) AS event_timestamp",
            "timestamp_seconds(proc_s) AS processing_timestamp",
        )

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
