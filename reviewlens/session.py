"""Session helper.  Master, memory and partition counts stay with the deployment."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(
    app: str = "reviewlens", config: dict[str, str] | None = None
) -> SparkSession:
    """Session with UTC dates and adaptive execution, which splits skewed joins."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
