"""The task ledger as a frame: filters, guarded transitions, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ledger_filter(
    ledger: DataFrame,
    prefix: str | None = None,
    status: str | None = None,
    limit: int | None = None,
    order_by: Sequence[str] = ("object_key",),
) -> DataFrame:
    """Tasks by key prefix and status; with ``limit`` the first of them in a stated order."""
    if prefix:
        ledger = ledger.filter(F.startswith("object_key", F.lit(prefix)))
    if status:
        ledger = ledger.filter(F.col("status") == status)
    return ledger.orderBy(*order_by).limit(limit) if limit is not None else ledger


def new_items(ledger: DataFrame, limit: int | None = None, order_by: Sequence[str] = ("object_key",)) -> DataFrame:
    """Tasks not started: status missing or NEW."""
    fresh = ledger.filter(F.col("status").isNull() | (F.col("status") == "NEW"))
    return fresh.orderBy(*order_by).limit(limit) if limit is not None else fresh


# Changes of a task that are applied one after the other in one row, as a power of two.
RUN_BITS = 16
PART_BITS = 33  # of an id: its place within its partition


def _states(froms: Column) -> Column:
    """The states a map tells apart: those named, and null for any other."""
    return F.array_append(F.array_compact(F.array_distinct(froms)), F.lit(None))


def _composed(entries: Column, froms: Column, holds) -> Column:
    """A map from state to state, as an array of ``(state, end)``: what ``entries`` make of each state one after the other.

    ``end`` has the status and time a task is left with, and ``took``, false if nothing applied and the task stays as it is.
    """

    def run(state: Column) -> Column:
        start = F.struct(state.alias("status"), F.lit(None).cast("string").alias("at"), F.lit(False).alias("took"))
        return F.struct(state.alias("state"), F.aggregate(entries, start, holds).alias("end"))

    return F.transform(_states(froms), run)


def _change(state: Column, c: Column) -> Column:
    applies = c["from_status"].isNull() | F.coalesce(state["status"] == c["from_status"], F.lit(False))
    return F.when(applies, F.struct(c["to_status"].alias("status"), c["at"].alias("at"), F.lit(True).alias("took"))).otherwise(state)


def _looked_up(map_: Column, status: Column) -> Column:
    """What a map makes of a status; a status it does not name goes the way of any other."""
    named = F.get(F.filter(map_, lambda e: e["state"] == status), F.lit(0))["end"]
    other = F.get(F.filter(map_, lambda e: e["state"].isNull()), F.lit(0))["end"]
    return F.coalesce(named, other)


def _map(state: Column, m: Column) -> Column:
    end = _looked_up(m["map"], state["status"])
    return F.when(end["took"], end).otherwise(state)


def transition_maps(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, map)``: all changes of a key, which have ``seq``, ``at``, ``to_status`` and ``from_status``, as one map from
    state to state.

    Composing maps is associative, so a key's changes need not meet in one row.  They are sorted by range, and one that
    holds a large share of all is spread over many partitions.  Runs of at most 2^16 changes are composed, then the maps of each
    partition, and last one map a partition is left for a key.  A map has a row for each state its changes
    name: its size depends on the number of states, not of changes.
    """
    order = ["seq", "at", "to_status", "from_status"]
    # Ids follow the order of the rows across and within the sorted partitions.  Equal changes may swap, which changes nothing.
    dealt = changes.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    dealt = dealt.withColumn("__id", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__id", PART_BITS))
    # Runs and parts are grouped where this puts them: both are within (keys, part).
    dealt = dealt.repartition(*keys, "__part").withColumn("__run", F.shiftright("__id", RUN_BITS))
    change = F.struct(F.col("__id").alias("id"), "at", "to_status", "from_status")
    runs = dealt.groupBy(*keys, "__part", "__run").agg(F.sort_array(F.collect_list(change)).alias("c"))
    runs = runs.select(*keys, "__part", "__run", _composed(F.col("c"), F.col("c.from_status"), _change).alias("map"))

    def joined(maps: DataFrame, by: Sequence[str], place: str) -> DataFrame:
        grouped = maps.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct(F.col(place).alias("id"), "map"))).alias("m"))
        states = F.flatten(F.transform("m", lambda m: m["map"]["state"]))
        return grouped.select(*by, _composed(F.col("m"), states, _map).alias("map"))

    return joined(joined(runs, [*keys, "__part"], "__run"), keys, "__part")


def ledger_transition(
    ledger: DataFrame,
    changes: DataFrame,
    keys: Sequence[str] = ("object_key",),
    match_timestamp: bool = False,
) -> DataFrame:
    """Apply status changes where their guards hold: one row per task, whatever the changes.

    ``changes`` has the keys, ``to_status``, and optionally ``from_status``, ``timestamp`` and ``seq``.  Several
    changes of a task are applied one after the other, by ``seq``, then time, then states; each sees the state the one
    before has left.  A change with a ``from_status`` applies only to a task in that state; with
    ``match_timestamp`` the times must be equal too and stay, otherwise the time is set along with the
    status.  ``applied`` tells whether any change took, and is null for tasks without a change.

    A task may have any number of changes: they are composed to one map from state to state (``transition_maps``), and the task
    looks up its own.
    """
    have, kinds = set(changes.columns), dict(ledger.dtypes)
    time = kinds.get("timestamp", "string")
    moves = "timestamp" in have and not match_timestamp

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    at = given("timestamp", time)
    asked = changes.select(
        *keys, given("seq", "long").alias("seq"), at.alias("__time"), at.cast("string").alias("at"),
        F.col("to_status").cast("string").alias("to_status"), given("from_status", "string").alias("from_status"),
    )
    keys = list(keys)
    if match_timestamp:
        # A task's time stays, so only changes of that time can ever apply: each time has a map of its own.
        stamp = F.col("timestamp") if "timestamp" in kinds else F.lit(None).cast(time)
        maps = transition_maps(asked.where(F.col("__time").isNotNull()), [*keys, "__time"])
        known = asked.select(*keys).distinct().withColumn("__asked", F.lit(True))
        joined = ledger.withColumn("__time", stamp).join(maps, [*keys, "__time"], "left").join(known, keys, "left")
    else:
        joined = ledger.join(transition_maps(asked.drop("__time"), keys).withColumn("__asked", F.lit(True)), keys, "left")
    ended = joined.withColumn("__end", _looked_up(F.col("map"), F.col("status")))
    took = F.coalesce(F.col("__end.took"), F.lit(False))
    updated = {"status": F.when(took, F.col("__end.status")).otherwise(F.col("status"))}
    if moves and "timestamp" in kinds:
        updated["timestamp"] = F.when(took, F.col("__end.at").cast(time)).otherwise(F.col("timestamp"))
    columns = [updated[c].alias(c) if c in updated else F.col(c) for c in ledger.columns]
    return ended.select(*columns, F.when(F.col("__asked"), took).alias("applied"))


def ledger_upsert(
    ledger: DataFrame, added: DataFrame, keys: Sequence[str] = ("object_key",)
) -> DataFrame:
    """Ledger with ``added`` rows put in; a row of the same key is replaced.

    Only the keys of the ledger are joined, so a small batch of additions is
    broadcast and the ledger stays where it is.  Of equal keys within ``added`` the
    largest row is taken.
    """
    rest = [c for c in ledger.columns if c not in keys]
    once = added.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("__row"))
    once = once.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])
    kept = ledger.join(once.select(*keys), list(keys), "left_anti").select(*ledger.columns)
    return kept.unionByName(once)
