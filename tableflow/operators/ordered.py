"""Ranks, runs and commit groups over one total order, without a one-task window.

Rows are cut into order-preserving buckets at approximate quantiles of the order column, so that each bucket holds a
bounded share whatever the distribution. Windows run inside buckets; a summary with one row per bucket carries
counts, or the last value, over to the next ones.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 2000
QUANTILE_ACCURACY = 20_000

POSITIONS_PER_BUCKET = 10_000

BUCKET = "__bucket"


def with_buckets(
    df: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET, n_rows: int | None = None
) -> DataFrame:
    """Add ``__bucket``: numbers that grow with the order column, each with about ``rows_per_bucket`` rows.

    One pass over the order column finds row count and quantiles; at most MAX_BUCKETS cut points come back. The
    order column is numeric and free of long ties, as message ids are. Rows without an order value come first, in a
    bucket of their own, whatever the number of rows. ``n_rows`` saves the pass when the caller knows that one bucket
    will do.
    """
    only = F.when(F.col(order).isNull(), F.lit(-1.0)).otherwise(F.lit(0.0))
    if n_rows is not None and n_rows <= rows_per_bucket:
        return df.withColumn(BUCKET, only)
    probe = ", ".join(f"{i / MAX_BUCKETS}D" for i in range(1, MAX_BUCKETS))
    # the sketch is cheap next to a second pass, and is thinned out to the bucket count needed
    quantiles = F.expr(f"percentile_approx(`{order}`, array({probe}), {QUANTILE_ACCURACY})")
    n, cuts = df.agg(F.count(F.lit(1)), quantiles).first()
    want = min(MAX_BUCKETS, -(-n // rows_per_bucket)) if n else 1
    if want <= 1 or not cuts:
        return df.withColumn(BUCKET, only)
    step = MAX_BUCKETS / want
    inner = sorted({float(cuts[min(len(cuts) - 1, max(0, round(i * step) - 1))]) for i in range(1, want)})
    splits = [float("-inf"), *inner, float("inf")]
    if len(splits) < 3:
        return df.withColumn(BUCKET, only)
    as_double = df.withColumn("__order", F.col(order).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="__order", outputCol=BUCKET, handleInvalid="keep").transform(as_double)
    # the bucketizer's bucket for invalid values is the last one; they come first, as nulls sort
    return cut.withColumn(BUCKET, F.when(F.col(order).isNull(), F.lit(-1.0)).otherwise(F.col(BUCKET))).drop("__order")


def _earlier(summary: DataFrame, value: Column, by: Sequence[str], name: str) -> DataFrame:
    """Running total of ``value`` over earlier buckets; one row per bucket (and ``by`` value) goes in."""
    w = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    return summary.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)).cast("bigint"))


def add_rank(df: DataFrame, order: str, by: Sequence[str] = (), name: str = "_rank") -> DataFrame:
    """0-based position of each row in ``order``, per value of ``by``; ``df`` has buckets."""
    counts = df.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    before = _earlier(counts, F.col("__n"), by, "__before").drop("__n")
    inside = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by, BUCKET).orderBy(order)))
    # not a broadcast hint: with many ``by`` values the summary grows, and AQE sizes it at run time
    joined = inside.join(before, [*by, BUCKET])
    return joined.withColumn(name, F.col("__before") + F.col("__rn") - 1).drop("__before", "__rn")


def running_totals(
    df: DataFrame, totals: Mapping[str, Column], order: Sequence[str], at: str, by: Sequence[str] = (),
    per_bucket: int = POSITIONS_PER_BUCKET,
) -> DataFrame:
    """Add sums over the earlier rows of the same ``by`` values, in the order of the ``order`` columns and then of ``at``.

    ``at`` numbers the rows of one ``order`` value, as positions in a commit do, with or without gaps. Stretches of
    ``per_bucket`` numbers are summed first and laid end to end, so no task sees more rows than that, however many there
    are of one ``order`` value.
    """
    keys = [*by, *order, BUCKET]
    cut = df.withColumn(BUCKET, F.floor(F.col(at) / per_bucket)).withColumns({f"__v_{n}": F.coalesce(v, F.lit(0)) for n, v in totals.items()})
    sums = cut.groupBy(*keys).agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in totals])
    earlier = Window.partitionBy(*by).orderBy(*order, BUCKET).rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
    carried = sums.select(*keys, *[F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__c_{n}") for n in totals])
    inside = Window.partitionBy(*keys).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.select("*", *[F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0)).alias(f"__i_{n}") for n in totals])
    return placed.join(carried, keys).select(
        *[F.col(f"`{c}`") for c in df.columns], *[(F.col(f"__c_{n}") + F.col(f"__i_{n}")).cast("bigint").alias(n) for n in totals]
    )


def commit_groups(
    df: DataFrame, order: str, records_per_commit: int, by: Sequence[str] = (), name: str = "_group",
    rows_per_bucket: int = ROWS_PER_BUCKET, n_rows: int | None = None,
) -> DataFrame:
    """Number the commit each row falls into when every ``records_per_commit`` rows are committed."""
    ranked = add_rank(with_buckets(df, order, rows_per_bucket, n_rows), order, by, "__rank")
    return ranked.withColumn(name, F.floor(F.col("__rank") / records_per_commit).cast("bigint")).drop("__rank", BUCKET)


def schema_runs(
    df: DataFrame, order: str, key: str, name: str = "_run", rows_per_bucket: int = ROWS_PER_BUCKET,
    n_rows: int | None = None,
) -> DataFrame:
    """Number the stretches of rows that share ``key`` in ``order``: every change of key starts a new one."""
    bucketed = with_buckets(df, order, rows_per_bucket, n_rows)
    # max_by passes over rows without an order value, which have a bucket of their own and no order among them
    at = F.coalesce(F.col(order).cast("double"), F.lit(float("-inf")))
    ends = bucketed.groupBy(BUCKET).agg(F.max_by(F.struct(F.col(key).alias("k")), at).alias("__end"))
    carried = ends.select(BUCKET, F.lag("__end").over(Window.orderBy(BUCKET)).alias("__carry"))  # one row per bucket
    inside = Window.partitionBy(BUCKET).orderBy(order)
    prev = F.coalesce(F.lag(F.struct(F.col(key).alias("k"))).over(inside), F.col("__carry"))
    marked = (
        bucketed.join(F.broadcast(carried), BUCKET)  # at most MAX_BUCKETS rows
        .withColumn("__new", F.when(prev.isNull() | prev["k"].eqNullSafe(F.col(key)), 0).otherwise(1))
        .drop("__carry")
    )
    starts = _earlier(marked.groupBy(BUCKET).agg(F.sum("__new").alias("__n")), F.col("__n"), (), "__before").drop("__n")
    running = F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        marked.join(F.broadcast(starts), BUCKET)
        .withColumn(name, (F.col("__before") + running).cast("bigint"))
        .drop("__before", "__new", BUCKET)
    )
