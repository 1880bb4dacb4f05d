"""Forecast-accuracy analytics on Spark: DataFrame in, DataFrame out.

``as_of`` stands for the current time everywhere, so a run can be repeated.
"""

from foretell.operators.accuracy import accuracy, hopping
from foretell.operators.alerts import detect_all as alerts
from foretell.operators.baseline import baselines
from foretell.operators.scoring import score
from foretell.operators.upsert import insert_missing, upsert
from foretell.plans.views import create_views as views
from foretell.streaming.hopping import stream_hopping
from foretell.streaming.pending_join import stream_pending_join
from foretell.streaming.rolling_alerts import stream_rolling_alerts

__all__ = [
    "accuracy",
    "alerts",
    "baselines",
    "hopping",
    "insert_missing",
    "score",
    "stream_hopping",
    "stream_pending_join",
    "stream_rolling_alerts",
    "upsert",
    "views",
]
