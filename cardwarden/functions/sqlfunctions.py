"""The scalar functions as temporary SQL functions.

A function's body is the SQL text of the same Column expression that the
DataFrame API uses, so there is one definition of each, and Catalyst inlines it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cardwarden.functions import expr


def _definitions() -> dict[str, tuple[str, str, Column]]:
    """name: (arguments, result, expression over the arguments)."""
    point = "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE"
    ends = ("lat1", "lon1", "lat2", "lon2")
    money = "total DECIMAL(25,2), threshold DECIMAL(25,2)"
    account = (
        "is_active BOOLEAN, locked_until TIMESTAMP, must_change_password BOOLEAN, failed_attempts INT, as_of TIMESTAMP"
    )
    state = ("is_active", "locked_until", "must_change_password", "failed_attempts")
    return {
        "haversine_km": (point, "DECIMAL(12,4)", expr.haversine_km(*ends)),
        "planar_km": (point, "DOUBLE", expr.planar_km(*ends)),
        "structuring_severity": (money, "STRING", expr.structuring_severity("total", F.col("threshold"))),
        "structuring_risk_score": (
            f"{money}, n BIGINT", "DECIMAL(14,2)", expr.structuring_risk_score("total", F.col("threshold"), "n"),
        ),
        "is_high_risk_mcc": ("mcc STRING", "BOOLEAN", expr.is_high_risk_mcc("mcc")),
        "merchant_risk_flag": (
            "is_blacklisted BOOLEAN, mcc STRING, risk DECIMAL(3,2)", "STRING",
            expr.merchant_risk_flag("is_blacklisted", "mcc", "risk"),
        ),
        "travel_risk": ("ratio DECIMAL(10,2)", "DECIMAL(4,2)", expr.travel_risk("ratio")),
        "travel_severity": ("ratio DECIMAL(10,2)", "STRING", expr.travel_severity("ratio")),
        "account_health": (account, "STRING", expr.account_health(*state, F.col("as_of"))),
    }


def _body(spark: SparkSession, arguments: str, column: Column) -> str:
    """The SQL text of an expression, resolved over arguments of the given types."""
    named = [a.strip().split(" ", 1) for a in re.split(r",(?![^(]*\))", arguments)]
    frame = spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in named))
    plan = frame.select(column.alias("value"))._jdf.queryExecution().analyzed()
    return plan.expressions().head().child().sql()


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions for this session and return their names."""
    made = _definitions()
    for name, (arguments, result, column) in made.items():
        body = _body(spark, arguments, column)
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(made)
