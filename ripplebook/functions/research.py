"""Research columns: edges, triggers, profit and loss, replay intervals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def buy_edge(fair: Column, price: Column) -> Column:
    return fair - price


def sell_edge(fair: Column, price: Column) -> Column:
    return price - fair


def fires(edge: Column, min_edge: float) -> Column:
    return edge >= F.lit(min_edge)


def realized_pnl(cash: Column, settlement: Column, fees: Column) -> Column:
    return cash + settlement - fees


@dataclass(frozen=True)
class Interval:
    """From ``start_ts_ns`` to ``end_ts_ns``, both included."""

    start_ts_ns: int
    end_ts_ns: int

    def contains(self, ts: Column) -> Column:
        return ts.between(self.start_ts_ns, self.end_ts_ns)


def replay(events: DataFrame, interval: Interval) -> DataFrame:
    """Events of the interval, in order of their sequence numbers."""
    return events.filter(interval.contains(F.col("event_ts_ns"))).orderBy("global_event_seq")
