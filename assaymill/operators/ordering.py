"""Row numbers, first rows and running values that survive a hot key.

A window puts all rows of its key in one task. The functions here range-partition
on key *and* order instead, so a key with a third of the rows is spread over many
tasks; only one small row per (key, partition) is combined afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from assaymill.session import cut


def first_by(df: DataFrame, keys: list[str], order: list[str], descending: bool = False) -> DataFrame:
    """The first row per key in ``order``, as a partial aggregate instead of a window.

    ``order`` must end in a unique column. NULLs sort first, as in ``ORDER BY``.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    rank = F.struct(*order)
    best = F.max_by(row, rank) if descending else F.min_by(row, rank)
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def spread(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` sorted over range partitions, written down with ``_part`` and a rising ``_id``.

    The cut fixes which row lies where, so that a recomputed task cannot move a border.
    """
    by = [F.col(k) for k in keys] + order
    ranged = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    return cut(ranged.withColumn("_part", F.shiftright("_id", 33)))


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn", total: str = "n") -> DataFrame:
    """1-based position of each row within its key, and the size of the key.

    ``order`` must be unique within a key.
    """
    fixed = spread(df, keys, order)
    spans = fixed.groupBy(*keys, "_part").agg(F.min("_id").alias("_low"), F.count(F.lit(1)).alias("_size"))
    every = Window.partitionBy(*keys)
    before = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *keys,
        "_part",
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_low") + 1).alias("_shift"),
        F.sum("_size").over(every).alias(total),
    )
    return (
        fixed.join(spans, [*keys, "_part"])
        .withColumn(name, F.col("_id") + F.col("_shift"))
        .drop("_id", "_shift", "_part")
    )


def running_total(
    df: DataFrame, keys: list[str], order: list[Column], value: str, name: str, total: str = "_total"
) -> DataFrame:
    """Sum of ``value`` over the rows of the key before this one, and over all of them.

    ``order`` must be unique within a key. The result keeps ``_part`` for
    ``running_min_from_end``.
    """
    fixed = spread(df, keys, order)
    earlier = Window.unboundedPreceding, -1
    every = Window.partitionBy(*keys)
    parts = (
        fixed.groupBy(*keys, "_part")
        .agg(F.sum(value).alias("_sum"))
        .select(
            *keys, "_part",
            F.coalesce(F.sum("_sum").over(every.orderBy("_part").rowsBetween(*earlier)), F.lit(0)).alias("_base"),
            F.sum("_sum").over(every).alias(total),
        )
    )
    here = F.sum(value).over(Window.partitionBy(*keys, "_part").orderBy("_id").rowsBetween(*earlier))
    return (
        fixed.withColumn("_here", F.coalesce(here, F.lit(0)))
        .join(parts, [*keys, "_part"])
        .withColumn(name, F.col("_here") + F.col("_base"))
        .drop("_here", "_base", "_id")
    )


def running_min_from_end(df: DataFrame, keys: list[str], value: str, position: str, name: str) -> DataFrame:
    """Minimum of ``value`` over this and all later positions of a ``running_total`` frame."""
    later_rows = (
        Window.partitionBy(*keys, "_part").orderBy(F.desc(position)).rowsBetween(Window.unboundedPreceding, 0)
    )
    later_parts = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        df.groupBy(*keys, "_part")
        .agg(F.min(value).alias("_min"))
        .select(*keys, "_part", F.min("_min").over(later_parts).alias("_later"))
    )
    return (
        df.withColumn("_here", F.min(value).over(later_rows))
        .join(parts, [*keys, "_part"])
        .withColumn(name, F.least("_here", F.coalesce("_later", "_here")))
        .drop("_here", "_later")
    )


def value_spans(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct non-NULL values per key with the rows below (``before``), at (``size``) and in all (``total``).

    Equal values are counted before anything is sorted, so a value shared by most rows
    is one row here.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("size"))
    return running_total(counts, keys, [F.col(value)], "size", "before", "total")


def quantiles(df: DataFrame, keys: list[str], value: str, names: dict[str, float]) -> DataFrame:
    """Exact quantiles per key with linear interpolation, one column per name."""
    spans = value_spans(df, keys, value)

    def at(rank: Column) -> Column:
        inside = (F.col("before") <= rank) & (rank < F.col("before") + F.col("size"))
        return F.max(F.when(inside, F.col(value).cast("double")))

    ends = []
    for name, share in names.items():
        place = (F.col("total") - 1) * F.lit(share)
        low = F.floor(place)
        ends += [at(low).alias(f"{name}_lo"), at(F.least(low + 1, F.col("total") - 1)).alias(f"{name}_hi")]
    bounds = spans.groupBy(*keys).agg(*ends, F.max("total").alias("total"))

    def between(name: str, share: float) -> Column:
        place = (F.col("total") - 1) * F.lit(share)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        return (low + (high - low) * (place - F.floor(place))).alias(name)

    return bounds.select(*keys, *[between(name, share) for name, share in names.items()])


def average_rank(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Ascending rank of ``value`` within its key; equal values share their mean rank."""
    rank = F.col("before") + (F.col("size") + 1) / 2
    ranks = value_spans(df, keys, value).select(*keys, value, rank.alias(name))
    return df.join(ranks, [*keys, value])
