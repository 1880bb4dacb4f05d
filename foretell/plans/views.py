"""Reporting views in SQL over the stored tables, ``as_of`` in place of now()."""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

TABLES = ("market_accuracy_aggregates", "market_correlations", "anomaly_alerts", "pipeline_health")

# ROUND(AVG(x), k) is written out on exact units: see functions/numeric.py
_PCT = "floor(sum(cast(floor(accuracy_rate * 1e4 + 0.5D) as bigint)) / count(accuracy_rate) + 0.5D) / 1e2"

VIEWS = {
    "v_current_accuracy": f"""
        SELECT location_name, market_type,
               {_PCT} AS accuracy_pct,
               floor(sum(cast(floor(avg_prediction_error * 1e4 + 0.5D) as bigint))
                     / count(avg_prediction_error) + 0.5D) / 1e4 AS avg_error,
               sum(total_predictions) AS total_predictions,
               max(window_end) AS last_updated
        FROM market_accuracy_aggregates
        WHERE window_start >= {{as_of}} - INTERVAL 24 HOURS
        GROUP BY location_name, market_type
        ORDER BY accuracy_pct DESC""",
    "v_recent_correlations": """
        SELECT location_name, market_type, correlation_method, actual_outcome,
               prediction_error, yes_price, actual_temp_c, actual_precip_mm, created_at
        FROM market_correlations
        WHERE created_at >= {as_of} - INTERVAL 24 HOURS
        ORDER BY created_at DESC""",
    "v_active_alerts": """
        SELECT alert_type, severity, location_name, market_type, message,
               metric_value, threshold_value, detected_at,
               CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2
                             WHEN 'medium' THEN 3 WHEN 'low' THEN 4 END AS severity_rank
        FROM anomaly_alerts
        WHERE NOT is_resolved
        ORDER BY severity_rank, detected_at DESC""",
    "v_accuracy_trend": f"""
        SELECT date_trunc('HOUR', window_start) AS hour, location_name, market_type,
               {_PCT} AS accuracy_pct,
               sum(total_predictions) AS predictions
        FROM market_accuracy_aggregates
        WHERE window_start >= {{as_of}} - INTERVAL 7 DAYS
        GROUP BY 1, 2, 3
        ORDER BY 1 DESC""",
    "v_pipeline_health": """
        SELECT component, status, messages_processed, error_count,
               last_message_at, latency_ms, recorded_at
        FROM pipeline_health
        WHERE recorded_at = (SELECT max(ph2.recorded_at) FROM pipeline_health ph2
                             WHERE ph2.component = pipeline_health.component)
        ORDER BY component""",
}


def view_sql(name: str, as_of: str) -> str:
    return VIEWS[name].format(as_of=f"TIMESTAMP '{as_of}'")


def query_view(spark: SparkSession, name: str, as_of: str, **tables: DataFrame) -> DataFrame:
    """Run one view over the given frames, under names that no other view bears."""
    sql = view_sql(name, as_of)
    for table, frame in tables.items():
        own = f"{table}_{uuid4().hex}"
        frame.createOrReplaceTempView(own)
        sql = re.sub(rf"\b{table}\b", own, sql)
    return spark.sql(sql)


def create_views(spark: SparkSession, as_of: str, **tables: DataFrame) -> None:
    """Register tables and every view whose table is given."""
    for table, frame in tables.items():
        frame.createOrReplaceTempView(table)
    for name, sql in VIEWS.items():
        if any(f"FROM {t}\n" in sql for t in tables):
            spark.sql(view_sql(name, as_of)).createOrReplaceTempView(name)
