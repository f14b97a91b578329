"""Order across a cluster without a task that holds a whole group: running totals, ordered
neighbours, dense numbers and exact quantiles.

Rows are range-partitioned by (keys, order), so a key with a third of all rows lies in many
partitions.  Windows run inside (partition, key); what passes from one partition of a key to the
next - a subtotal, a border row - is one row per partition and key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandflow.session import materialize

_PART = "__part"


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows with the number of their range partition.  Written once: both readers must see
    the same bounds, whatever is recomputed after a lost executor."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(_dealt(df, n, keys, order))


def _dealt(df: DataFrame, n: int, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return df.repartitionByRange(n, *keys, *order).withColumn(_PART, F.spark_partition_id())


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of (partition, keys)."""
    cond = F.col(f"{a}.{_PART}") == F.col(f"{b}.{_PART}")
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def running_totals(df: DataFrame, keys: Iterable[str], order: Iterable[str], weight: str, out: str = "upto") -> DataFrame:
    """``out``: sum of ``weight`` over the rows of the same keys up to this one by ``order``, which
    must tell the rows of a key apart."""
    keys, order = list(keys), list(order)
    rows = _ranged(df, keys, order)
    parts = rows.groupBy(_PART, *keys).agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(_PART, *keys, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("__local", F.sum(weight).over(inside))
    joined = local.alias("a").join(parts.alias("b"), _same("a", "b", keys))
    return joined.select(*[F.col(f"a.`{c}`") for c in df.columns], (F.col("a.__local") + F.col("b.__before")).alias(out))


def previous_values(df: DataFrame, keys: Iterable[str], order: Iterable[str], value: str, out: str,
                    total: tuple[str, list[str], str] | None = None, keep: Iterable[str] | None = None) -> DataFrame:
    """``out``: ``value`` of the previous row of the same keys by ``order`` (null on the first).
    ``total`` (column, some of the keys, name) adds the number of non-null entries of a column
    among the rows that share these keys, from the same pass.  ``keep`` names the columns that are
    wanted beside these (default: all); columns that only order the rows are not written.

    Rows are written in order with their place, a number, so that what follows sorts by it and the
    border rows are a plain aggregate.  The rows move once more, to the window and the join together."""
    keys, order = list(keys), list(order)
    keep = list(df.columns) if keep is None else list(keep)
    counted = total[0] if total else None
    carried = list(dict.fromkeys([*keep, *keys, value, *([counted] if counted else [])]))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = _dealt(df, n, keys, order).sortWithinPartitions(*keys, *order)
    rows = materialize(ordered.select(*carried, _PART, F.monotonically_increasing_id().alias("__at")))
    borders = rows.groupBy(_PART, *keys).agg(F.max_by(value, "__at").alias("__last"),
                                             F.count(counted if counted else F.lit(1)).alias("__n"))
    columns = [F.lag("__last").over(Window.partitionBy(*keys).orderBy(_PART)).alias("__carried")]
    if total:
        columns.append(F.sum("__n").over(Window.partitionBy(*total[1])).alias(total[2]))
    # nulls in a struct are equal, so window and join share one exchange (eqNullSafe would add another)
    key = F.struct(*keys).alias("__key")
    borders = borders.select(_PART, key, *columns)
    inside = Window.partitionBy(_PART, "__key").orderBy("__at")
    local = rows.select(_PART, "__at", key, *[c for c in carried if c not in keys])
    local = local.withColumns({"__lag": F.lag(value if value not in keys else f"__key.{value}").over(inside),
                               "__nth": F.row_number().over(inside)})
    joined = local.alias("a").join(borders.alias("b"), [_PART, "__key"])
    first = F.when(F.col("a.__nth") == 1, F.col("b.__carried")).otherwise(F.col("a.__lag"))
    extra = [F.col(f"b.{total[2]}")] if total else []
    return joined.select(*[F.col(f"__key.`{c}`" if c in keys else f"a.`{c}`") for c in keep], first.alias(out), *extra)


def dense_numbers(values: DataFrame, key: str, out: str) -> DataFrame:
    """1, 2, ... for the distinct non-null values of ``key``, ascending."""
    one = values.select(key).where(F.col(key).isNotNull()).distinct().withColumn("__one", F.lit(1).cast("bigint"))
    return running_totals(one, [], [key], "__one", out).drop("__one")


def value_ranks(long: DataFrame, keys: Iterable[str], value: str) -> DataFrame:
    """One row per (keys, distinct non-null value): its count ``c`` and ``upto``, how many values
    of the keys are not above it.  Equal values collapse before the shuffle."""
    keys = list(keys)
    counts = long.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("c"))
    return running_totals(counts, keys, [value], "c")


def exact_quantiles(long: DataFrame, keys: Iterable[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per keys (name -> probability), by picking the values at two
    ranks from the running counts; no task sees all values of a key."""
    return quantiles_of_ranks(value_ranks(long, keys, value), keys, value, "c", quantiles)


def quantiles_of_ranks(ranks: DataFrame, keys: Iterable[str], value: str, count: str, quantiles: dict[str, float]) -> DataFrame:
    """Quantiles from rows ``keys, value, count, upto`` (see :func:`value_ranks`)."""
    keys = list(keys)
    total = ranks.groupBy(*keys).agg(F.sum(count).alias("__n"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    both = ranks.alias("a").join(total.alias("b"), cond).select(*[F.col(f"a.{k}") for k in keys], F.col(f"a.{value}").alias("__x"), "a.upto", "b.__n")
    aggs = [F.max("__n").alias("__n")]
    for name, p in quantiles.items():
        at = (F.col("__n") - 1) * F.lit(p)
        aggs += [F.min(F.when(F.col("upto") > F.floor(at), F.col("__x"))).alias(f"__lo_{name}"),
                 F.min(F.when(F.col("upto") > F.ceil(at), F.col("__x"))).alias(f"__hi_{name}")]
    picked = both.groupBy(*keys).agg(*aggs)

    def between(name: str, p: float) -> Column:
        at = (F.col("__n") - 1) * F.lit(p)
        lo, hi = F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double")
        return (lo + (hi - lo) * (at - F.floor(at))).alias(name)

    return picked.select(*keys, *[between(name, p) for name, p in quantiles.items()])
