"""Risk score and the alert row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: scores and the scale of the risk formula -----------------------------------
SCORE_RAPID_ORDERS = 0.85
SCORE_HIGH_VALUE_FIRST_ORDER = 0.75
SCORE_LOCATION_ANOMALY = 0.65
NEGATIVE_AMOUNT_SCORE = 0.95
AMOUNT_AT_FULL_SCALE = 200000.0
AMOUNT_SCORE_LIMIT = 0.9
FIRST_ORDER_BONUS = 0.1
# ----------------------------------------------------------------------------------------------


def risk_score(amount: Column, first_order: Column) -> Column:
    by_amount = F.least(amount / AMOUNT_AT_FULL_SCALE, F.lit(AMOUNT_SCORE_LIMIT))
    bonus = F.when(first_order, F.lit(FIRST_ORDER_BONUS)).otherwise(F.lit(0.0))
    """Null for a null amount."""
    return F.when(amount.isNull(), F.lit(None).cast("double")).otherwise(
        F.when(amount < 0, F.lit(NEGATIVE_AMOUNT_SCORE))
        .when(amount == 0, F.lit(0.0))
        .otherwise(F.least(by_amount + bonus, F.lit(1.0)))
    )


def alert_rows(
    hits: DataFrame,
    alert_type: str,
    score: float | Column,
    description: Column,
    related: Column,
    detected_at: Column | None = None,
) -> DataFrame:
    """Alert table rows from rows with ``user_id`` and ``order_id``.

    The id is a digest of what was detected, so a replay gives the same id and a retry no second
    alert. ``detected_at`` is the wall clock unless given.
    """
    when = F.current_timestamp() if detected_at is None else detected_at
    return hits.select(
        F.sha2(F.concat_ws("|", F.col("user_id"), F.lit(alert_type), F.col("order_id")), 256)
        .alias("alert_id"),
        "user_id",
        "order_id",
        F.lit(alert_type).alias("alert_type"),
        (score if isinstance(score, Column) else F.lit(score)).alias("risk_score"),
        description.alias("description"),
        when.alias("detected_at"),
        related.alias("related_events"),
    )
