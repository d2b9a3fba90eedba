"""Skew-safe as-of running totals: for each probe, sums of earlier events of its key.

``running_totals`` answers, for every probe row (key k, time t), the sums of
event values with key k and event time <= t. This is a range (theta) join, but it
emits no pairs, puts no key group into a single task, and is one lazy plan:

1. Events are summed per (key, time), and probe times are added with zero. Equal
   times combine map-side, so a key has at most one row per microsecond.
2. The running sum up to t is the sum of whole days before, of whole seconds before
   in that day, and of times up to t in that second. Each is a window over a group
   of bounded size: a key's days, a day's 86,400 seconds, a second's 1,000,000
   microseconds. A key that holds a third of all rows is spread over its seconds.
3. Probes take the sum of their (key, time) by an equi join, which adaptive
   execution splits when a key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    probes: DataFrame, events: DataFrame, key: str, probe_time: str, event_time: str, values: list[str]
) -> DataFrame:
    """Probe columns plus one ``<value>`` column per event value: sums over events
    with the same key and event time <= probe time (0 when none, or when the probe's
    key or time is NULL)."""
    totals = totals_at(probes, events, key, probe_time, event_time, values)
    return with_totals(probes, totals, key, probe_time, values)


def with_totals(probes: DataFrame, totals: DataFrame, key: str, probe_time: str, values: list[str]) -> DataFrame:
    """Probe columns plus the values of ``totals_at``, 0 for a probe that is not in them."""
    types = {v: totals.schema[f"_v_{v}"].dataType for v in values}
    joined = probes.join(totals, (F.col(key) == F.col("_k")) & (F.col(probe_time) == F.col("_t")), "left")
    return joined.select(*probes.columns, *[F.coalesce(f"_v_{v}", F.lit(0).cast(types[v])).alias(v) for v in values])


def totals_at(
    probes: DataFrame, events: DataFrame, key: str, probe_time: str, event_time: str, values: list[str]
) -> DataFrame:
    """(_k, _t, _v_<value>): the sums at every different (key, time) of probes and events; only those two columns
    of the probes are read."""
    types = {v: events.schema[v].dataType for v in values}
    zero = {v: F.lit(0).cast(types[v]) for v in values}
    # a NULL key or time matches nothing, as in an equi/theta join
    happened = events.where(F.col(key).isNotNull() & F.col(event_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(event_time).alias("_t"), *[F.coalesce(v, zero[v]).alias(v) for v in values]
    )
    asked = probes.where(F.col(key).isNotNull() & F.col(probe_time).isNotNull()).select(
        F.col(key).alias("_k"), F.col(probe_time).alias("_t"), *[zero[v].alias(v) for v in values]
    )
    sums = [F.sum(v).cast(types[v]).alias(v) for v in values]
    points = (
        happened.unionByName(asked)
        .groupBy("_k", "_t")
        .agg(*sums)
        .withColumn("_day", F.to_date("_t"))
        .withColumn("_second", F.hour("_t") * 3600 + F.minute("_t") * 60 + F.second("_t"))
    )
    upto = Window.unboundedPreceding
    in_second = Window.partitionBy("_k", "_day", "_second").orderBy("_t").rowsBetween(upto, 0)
    in_day = Window.partitionBy("_k", "_day").orderBy("_second").rowsBetween(upto, -1)
    over_days = Window.partitionBy("_k").orderBy("_day").rowsBetween(upto, -1)
    seconds = points.groupBy("_k", "_day", "_second").agg(*sums)
    days = seconds.groupBy("_k", "_day").agg(*sums)
    before = seconds.select("_k", "_day", "_second", *[F.sum(v).over(in_day).alias(f"_s_{v}") for v in values]).join(
        days.select("_k", "_day", *[F.sum(v).over(over_days).alias(f"_d_{v}") for v in values]), ["_k", "_day"]
    )
    return (
        points.select("_k", "_t", "_day", "_second", *[F.sum(v).over(in_second).alias(v) for v in values])
        .join(before, ["_k", "_day", "_second"])
        .select(
            "_k",
            "_t",
            *[
                (F.col(v) + F.coalesce(f"_s_{v}", zero[v]) + F.coalesce(f"_d_{v}", zero[v])).cast(types[v]).alias(f"_v_{v}")
                for v in values
            ],
        )
    )
