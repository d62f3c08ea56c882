"""Exact ranks and running totals without a one-task window.

Rows get a bucket that is a monotone function of the sort key. Totals per bucket give each bucket
its offset, and the window only ever orders rows inside one bucket. The window and the offset join
share one hash partitioning by (group, bucket).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peerledger.functions.hashing import seeded_digest

BUCKET = "_bucket"
ROWS_PER_BUCKET = 50_000
GROUP = "_group"


def score_buckets(df: DataFrame, score: str, buckets: int | None = None, output: str = BUCKET) -> DataFrame:
    """Bucket rows by approximate quantiles of `score`; the cut points are literals of the plan,
    so a recomputed task sees the same buckets."""
    if buckets is None:
        buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probabilities = [i / buckets for i in range(1, buckets)]
    cuts = df.approxQuantile(score, probabilities, 1 / (4 * buckets))
    inner = sorted(set(cuts) - {float("-inf"), float("inf")}) or [0.0]
    splits = [float("-inf"), *inner, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=score, outputCol=output, handleInvalid="error")
    return bucketed.transform(df).withColumn(output, F.col(output).cast("int"))


def grouped(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the group as one never-null column, in which NULL keys equal each other. Join, window
    and aggregate can then share a single hash partitioning."""
    return df.withColumn(GROUP, F.struct(*by) if by else F.lit(0))


def with_offsets(df: DataFrame, totals: Mapping[str, Column], descending: bool = False) -> DataFrame:
    """Add, per row of a grouped and bucketed frame, the totals of all earlier buckets of its group."""
    sums = df.groupBy(GROUP, BUCKET).agg(*[c.alias(n) for n, c in totals.items()])
    order = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    earlier = Window.partitionBy(GROUP).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        GROUP, BUCKET, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in totals]
    )
    return df.join(offsets, [GROUP, BUCKET], "inner")


def with_next(df: DataFrame, order: str, output: str) -> DataFrame:
    """Add, per row of a grouped and bucketed frame, the next larger value of `order` in its group; buckets are monotone in it."""
    firsts = df.groupBy(GROUP, BUCKET).agg(F.min(order).alias("_first"))
    later = Window.partitionBy(GROUP).orderBy(BUCKET)
    following = firsts.select(GROUP, BUCKET, F.lead("_first").over(later).alias("_later"))
    inside = Window.partitionBy(GROUP, BUCKET).orderBy(order)
    placed = df.join(following, [GROUP, BUCKET])
    return placed.withColumn(output, F.coalesce(F.lead(order).over(inside), F.col("_later"))).drop("_later")


def hash_rank(
    df: DataFrame, key: str, seed: int, by: Sequence[str] = (), output: str = "rank", digits: int | None = None
) -> DataFrame:
    """1-based rank of each row in the order of its seeded hash, within `by`. Without `digits`, rows are counted to choose them.

    `key` must be unique within `by`. Hash prefixes are uniform, so the 16**digits buckets stay
    even however uneven the groups are.
    """
    kept = df.columns
    if digits is None:
        rows, digits = df.count(), 1
        while 16**digits * ROWS_PER_BUCKET < rows:
            digits += 1
    hashed = grouped(df, by).withColumn("_digest", seeded_digest(F.col(key), seed))
    hashed = hashed.withColumn(BUCKET, F.substring("_digest", 1, digits))
    placed = with_offsets(hashed, {"_before": F.count("*")})
    inside = Window.partitionBy(GROUP, BUCKET).orderBy("_digest", key)
    return placed.select(*kept, (F.row_number().over(inside) + F.col("_before")).cast("bigint").alias(output))
