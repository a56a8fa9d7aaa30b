"""Order, ranks and running sums of a table that no single task reads.

:func:`in_order` stores a table cut into ranges of its sort key. What lies before a range is then
known from one row per range, so a rank or a running sum is that offset and a value inside one
range. The ranges hold about equally many rows; the sort key should not repeat much, as rows with
equal keys share a range.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuscope.staging import measured, stage

RANGE, PLACE = "_range", "_place"  # number of the range, and place in it from 0
_PLACE_BITS = 33  # of a generated id, the rest is the task's number


def in_order(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` in total order, with its range and place columns; runs a job that stores it by range."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()
    marked = placed.select(
        "*", at.bitwiseAND((1 << _PLACE_BITS) - 1).alias(PLACE), F.shiftright(at, _PLACE_BITS).cast("int").alias(RANGE)
    )
    return stage(marked, "in-order", partition_by=RANGE)


def same(columns: Sequence[str], prefix: str = "_of_") -> list[Column]:
    """Join conditions between columns and their prefixed copies; NULL equals NULL."""
    return [F.col(name).eqNullSafe(F.col(prefix + name)) for name in columns]


def prefixed(df: DataFrame, columns: Sequence[str], prefix: str = "_of_") -> DataFrame:
    return df.withColumnsRenamed({name: prefix + name for name in columns})


def offsets(ordered: DataFrame, sums: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """For each range (and group in it): ``<name>_before``, ``<name>_here`` and ``<name>_total`` of every sum.

    At most one row for each range, and one more for each group, whose columns must lead the order.
    """
    here = ordered.groupBy(*by, RANGE).agg(*[F.sum(value).alias(f"{name}_here") for name, value in sums.items()])
    group = Window.partitionBy(*by)
    earlier = group.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return here.select(
        *by, RANGE, *[F.col(f"{name}_here") for name in sums],
        *[F.coalesce(F.sum(f"{name}_here").over(earlier), F.lit(0)).alias(f"{name}_before") for name in sums],
        *[F.sum(f"{name}_here").over(group).alias(f"{name}_total") for name in sums],
    )


def running_sums(ordered: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """The rows with ``<name>_upto``, the sum up to and with the row, and ``<name>_total``, of every sum."""
    before = F.broadcast(offsets(ordered, sums))  # one row for each range
    inside = Window.partitionBy(RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    upto = ordered.select("*", *[F.sum(value).over(inside).alias(f"{name}_inside") for name, value in sums.items()])
    return upto.join(before, RANGE).select(
        *[F.col(c) for c in ordered.columns],
        *[(F.col(f"{name}_before") + F.col(f"{name}_inside")).alias(f"{name}_upto") for name in sums],
        *[F.col(f"{name}_total") for name in sums],
    )


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """The rows with their position in the whole order, from 1, as ``name``; shuffles nothing but counts of the ranges."""
    before = F.broadcast(offsets(ordered, {"rows": F.lit(1)}).select(RANGE, "rows_before"))
    rows = ordered.join(before, RANGE)
    return rows.select(*[F.col(c) for c in ordered.columns], (F.col("rows_before") + F.col(PLACE) + 1).alias(name))


def quantiles(ordered: DataFrame, shares: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of ``value``, which each row holds ``n`` times, for every group; one column for each share.

    A quantile between two values is interpolated. ``ordered`` is in order of ``by`` and the value. The
    ranges' counts tell which range holds a wanted rank; only those ranges are read again, and a task
    sums inside one range and group. Runs the jobs that count and pick the ranges; their list, at most all ranges, is collected.
    """
    position = (F.col("n_total") - 1) * F.col("share")
    wanted = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(share).alias("share")) for name, share in shares.items()]))
    asked = offsets(ordered, {"n": F.col("n")}, by).select("*", wanted.alias("w")).select("*", "w.name", "w.share").select(
        "*", F.explode(F.array(
            F.struct(F.lit("low").alias("side"), F.floor(position).alias("rank")), F.struct(F.lit("high").alias("side"), F.ceil(position).alias("rank"))
        )).alias("r"), position.alias("position"),
    )
    inside = F.col("r.rank") - F.col("n_before")
    hits = measured(asked.where((inside >= 0) & (inside < F.col("n_here"))).select(
        *by, RANGE, "name", "r.side", "position", inside.alias("at")
    ))
    ranges = sorted(r[0] for r in hits.select(RANGE).distinct().collect())
    cumulated = Window.partitionBy(*by, RANGE).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    rows = ordered.where(F.col(RANGE).isin(ranges)).select(*by, RANGE, "value", "n", F.sum("n").over(cumulated).alias("upto"))
    keys = [*by, RANGE]
    found = rows.join(prefixed(hits, keys), same(keys)).where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("n")))
    sides = found.groupBy(*by).agg(*[
        F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.struct("position", "value"))).alias(f"{name}_{side}")
        for name in shares for side in ("low", "high")
    ])
    return sides.select(*by, *[_between(F.col(f"{name}_low"), F.col(f"{name}_high")).alias(name) for name in shares])


def _between(low: Column, high: Column) -> Column:
    position = low["position"]
    mixed = (F.ceil(position) - position) * low["value"] + (position - F.floor(position)) * high["value"]
    return F.when(low["value"] == high["value"], low["value"]).otherwise(mixed)
