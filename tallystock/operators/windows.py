"""Ordered operators that stay distributed: first rows, numbering, running totals, fill-down."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystock.functions.measures import ratio_pct
from tallystock.session import materialize

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. ``order`` must be total within a key.

    Spark pushes the rank limit below the shuffle, so each task sends one row per key
    however many rows a hot key has.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def latest_per_key(df: DataFrame, key: str, date: str, tie_break: list[Column]) -> DataFrame:
    return first_per_key(df, [key], [F.col(date).desc(), *tie_break])


def _in_order(df: DataFrame, order: list[Column], label: str) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, stored with task (_task) and place (_place)."""
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    stored = materialize(placed, label)
    return stored.select(
        *df.columns,
        F.shiftright("_id", _POSITION_BITS).alias("_task"),
        F.col("_id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_place"),
    )


def _before(per_task: DataFrame, amount: str) -> DataFrame:
    """What earlier tasks hold. ``per_task`` has one row per task of the range shuffle."""
    w = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(per_task.withColumn("_before", F.sum(amount).over(w)).drop(amount))


def number_rows(df: DataFrame, order: list[Column], name: str = "RowNo") -> DataFrame:
    """1..n over the whole table in a total order, without gathering it in one task.

    Tasks number their own range; the number of rows in earlier ranges is added.
    """
    rows = _in_order(df, order, "numbered")
    sizes = rows.groupBy("_task").agg(F.count("*").alias("_n"))
    number = F.coalesce("_before", F.lit(0)) + F.col("_place") + 1
    return rows.join(_before(sizes, "_n"), "_task").select(*df.columns, number.alias(name))


def running_total(df: DataFrame, value: Column, order: list[Column], name: str) -> DataFrame:
    """Running sum over the whole table in a total order, range by range."""
    rows = _in_order(df.withColumn("_value", value), order, "running")
    inside = Window.partitionBy("_task").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy("_task").agg(F.sum("_value").alias("_n"))
    local = rows.withColumn("_local", F.sum("_value").over(inside))
    total = F.coalesce("_before", F.lit(0)) + F.col("_local")
    return local.join(_before(totals, "_n"), "_task").select(*df.columns, total.alias(name))


def fill_down(df: DataFrame, value: str, keys: list[str], order: str, name: str, block: int = 65536) -> DataFrame:
    """Carry the last non-null ``value`` to the rows below it, per group.

    A group of any size is cut into blocks of row numbers: inside a block a window does the
    work, and the value that enters a block comes from one summary row per block.
    """
    cut = df.withColumn("_block", F.floor(F.col(order) / block))
    whole = [*keys, "_block"]
    last_set = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))
    summary = cut.groupBy(*whole).agg(last_set.alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    entering = summary.select(*whole, F.last("_last", ignorenulls=True).over(earlier).alias("_entering"))
    inside = Window.partitionBy(*whole).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumn("_local", F.last(value, ignorenulls=True).over(inside))
    # A left join, so that rows without a group or row number are kept as they are.
    return local.join(entering, whole, "left").withColumn(name, F.coalesce("_local", "_entering")).drop(
        "_block", "_local", "_entering")


def share_of_total(groups: DataFrame, value: str, name: str) -> DataFrame:
    """Share of each group in the total of ``value``.

    The total is a scalar over the same grouped rows: Spark runs their shuffle once and
    reuses it, and no task has to hold all groups.
    """
    total = groups.agg(F.sum(value).alias("_total")).scalar()
    return groups.withColumn(name, ratio_pct(F.col(value), total))
