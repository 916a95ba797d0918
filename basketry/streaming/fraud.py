"""Keyed state for the two fraud rules that depend on event order."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.times import millis
from ..operators.fraud import RAPID_WITHIN, is_created, slice_width, time_slices

RAPID_SCHEMA = "user_id string, first string, second string, order_id string, event_time timestamp"
USER_GROUPS = 1024
FIRST_SCHEMA = "user_id string, order_id string, total_amount double, event_time timestamp"


class RapidOrders(StatefulProcessor):
    """Three new orders of one user in less than ``within``, found as the watermark passes the third.

    Keyed by group of users and slice (see ``user_group``, ``time_slices``). Orders wait until the watermark passes them
    and are then taken in time order; of those, the last two of a user stay to complete later hits. An order that arrives
    again counts once. When the watermark has passed the slice and its lookahead, the state is empty again.
    """

    def __init__(self, within_ms: int, width_ms: int):
        self.within_ms = within_ms
        self.width_ms = width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.orders = handle.getListState("orders", "user_id string, ms bigint, order_id string, taken boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        new = []
        for batch in rows:
            on_time = batch[batch["timestamp"] > watermark]
            new += [(user_id, ms, order_id, False) for user_id, ms, order_id in zip(
                on_time["user_id"], on_time["timestamp"].tolist(), on_time["order_id"])]
        if new:
            self.orders.appendList(new)
            self.handle.registerTimer(min(r[1] for r in new))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, slice_no = key
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = sorted((tuple(r) for r in self.orders.get()), key=lambda r: (r[0], r[1], r[2], not r[3]))
        hits, kept, later, news = [], [], [], False
        for user_id, own in groupby(rows, key=lambda r: r[0]):
            line = self._once(list(own))
            due = [r for r in line if r[1] <= watermark]
            hits += [
                (user_id, a[2], b[2], c[2], pd.Timestamp(c[1], unit="ms"))
                for a, b, c in zip(due, due[1:], due[2:])
                if not c[3] and a[1] // self.width_ms == slice_no and c[1] - a[1] < self.within_ms
            ]
            kept += [(*r[:3], True) for r in due[-2:]]
            later += line[len(due):]
            news = news or not all(r[3] for r in due)
        end = (slice_no + 1) * self.width_ms + self.within_ms
        if watermark >= end:
            self.orders.clear()
        elif news:
            self.orders.put(kept + later)
            self.handle.registerTimer(min((r[1] for r in later), default=end))
        if hits:
            yield pd.DataFrame(hits, columns=["user_id", "first", "second", "order_id", "event_time"])

    @staticmethod
    def _once(line: list[tuple]) -> list[tuple]:
        """The first of the rows of each order."""
        return list({r[2]: r for r in reversed(line)}.values())[::-1]


class FirstOrder(StatefulProcessor):
    """The first order seen of a user; later ones, whatever their amount, are passed over. Keyed by group of users, with
    an entry of the state for each user: only those of the batch are looked up."""

    def __init__(self, threshold: float, ttl_ms: int | None = None):
        self.threshold = threshold
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.seen = handle.getMapState("seen", "user_id string", "flag boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        firsts = {}
        for batch in rows:
            for first in next(_earliest(iter([batch]))).itertuples(index=False):
                known = firsts.get(first.user_id)
                if known is None or (first.timestamp, first.order_id) < (known.timestamp, known.order_id):
                    firsts[first.user_id] = first
        hits = []
        for user_id, first in firsts.items():
            if self.seen.containsKey((user_id,)):
                continue
            self.seen.updateValue((user_id,), (True,))
            if not pd.isna(first.total_amount) and first.total_amount > self.threshold:
                hits.append((user_id, first.order_id, float(first.total_amount), pd.Timestamp(first.timestamp, unit="ms")))
        if hits:
            yield pd.DataFrame(hits, columns=["user_id", "order_id", "total_amount", "event_time"])


def user_group() -> Column:
    """One of USER_GROUPS groups of users. Each key of a stateful Python operator costs several calls to the state store
    in a batch, so keys must not grow with the users."""
    return F.pmod(F.xxhash64("user_id"), F.lit(USER_GROUPS)).alias("user_group")


def rapid_hits(orders: DataFrame, within: timedelta = RAPID_WITHIN) -> DataFrame:
    """Hits of the rapid-order rule; ``orders`` has a watermark on ``event_time``.

    Orders of every status move the watermark on. So the filter names ``event_time``: any other
    filter Spark may apply before it looks at the event times.
    """
    created = orders.filter(F.when(F.col("event_time").isNotNull(), is_created()).otherwise(False))
    return (
        time_slices(created, within)
        .select(user_group(), "slice", "user_id", "timestamp", "order_id", "event_time")
        .groupBy("user_group", "slice")
        .transformWithStateInPandas(
            RapidOrders(millis(within), millis(slice_width(within))), RAPID_SCHEMA, "append", "eventtime"
        )
    )


def first_order_hits(orders: DataFrame, threshold: float, ttl: timedelta | None = None) -> DataFrame:
    """Users whose first order is above the threshold, in order of arrival. Orders that arrive in
    the same micro-batch count in time order. Without ``ttl`` a user is remembered for good, and
    the state grows with the number of users. With it the query has to run on a clock trigger: as
    users expire by wall clock, Spark never finds it drained."""
    if ttl is None:
        mode, ttl_ms = "none", None
    else:
        mode, ttl_ms = "processingtime", millis(ttl)
    columns = ("user_id", "timestamp", "order_id", "total_amount")
    thin = orders.filter(F.col("user_id").isNotNull()).select(*columns)
    return (
        thin.mapInPandas(_earliest, thin.schema)
        .select(user_group(), *columns)
        .groupBy("user_group")
        .transformWithStateInPandas(FirstOrder(threshold, ttl_ms), FIRST_SCHEMA, "append", mode)
    )


def _earliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keep each user's earliest order of every Arrow batch, so that a busy user reaches the state
    operator as a handful of rows per task."""
    for batch in batches:
        yield batch.sort_values(["timestamp", "order_id"]).drop_duplicates("user_id")
