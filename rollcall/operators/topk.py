"""Top-k and first-n."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows of an order, for an ``n`` of report size.

    Planned as TakeOrderedAndProject: every task keeps n rows, nothing is sorted as a whole.
    """
    return df.orderBy(*order).limit(n)


def largest_rows(
    df: DataFrame, n: int, value: str, *ties: str | Column, nulls: bool = True
) -> DataFrame:
    """Rows with the ``n`` largest values, NULLs last, for wide rows and an ``n`` of report size.

    A first pass over the value column alone finds the n-th largest value. Its result is a filter of
    the second pass that reaches the scan, so row groups whose maximum is below it are not read, and
    the other columns are not decoded for them. Rows equal to that value all stay until the ties
    are broken. Rows without a value only count when fewer than ``n`` rows have one; ``nulls=False``
    leaves them out, for columns known to have a value.
    """
    largest = top_rows(df.select(value), n, F.col(value).desc_nulls_last())
    found = df.where(F.col(value) >= largest.agg(F.min(value)).scalar())
    if nulls:
        short = largest.agg(F.count(value)).scalar() < n
        # Ties are broken among them as among any equal values, n rows per task at most.
        without = top_rows(df.where(F.col(value).isNull() & short), n, *(ties or [F.lit(0)]))
        found = found.unionByName(without)
    return top_rows(found, n, F.col(value).desc_nulls_last(), *ties)


def first_by_key(df: DataFrame, key: str, n: int, chars: int = 4, spare: int = 4) -> DataFrame:
    """First ``n`` rows by a text key, NULLs first, for an ``n`` of sample size.

    Keeping n rows per task would send tasks * n rows to the last one. So rows are first counted by
    the leading characters of the key, and only those up to the bucket that holds the n-th row go on.
    While that bucket alone has more than ``spare * n`` rows, since many keys begin alike, its rows are
    counted again by twice as many characters; one row of counts comes back each time. Exact: no row past
    that bucket can be among the first n.
    """
    inside, before, kept = F.lit(True), 0, None
    while True:
        bucket = F.substring(key, 1, chars)
        counts = df.where(inside).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
        upto = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)) + before)
        edge = counts.where(F.col("before") < n).orderBy(F.desc("before")).first()
        if edge is None:
            return df.limit(0)
        kept = bucket.isNull() if edge.bucket is None else bucket.isNull() | (bucket <= edge.bucket)
        if edge.bucket is None or edge.n <= spare * n or len(edge.bucket) < chars:
            return df.where(kept).orderBy(key).limit(n)
        inside, before, chars = bucket == edge.bucket, edge.before, 2 * chars


def top_groups(df: DataFrame, key: str, value: Column, n: int, name: str) -> DataFrame:
    """Groups with the ``n`` largest aggregates; rows without a key belong to no group."""
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(value.alias(name))
    return top_rows(grouped, n, F.col(name).desc_nulls_last(), F.col(key))


def rows_of_top_groups(df: DataFrame, key: str, value: Column, n: int) -> DataFrame:
    """All rows of the groups with the ``n`` largest aggregates, from one reading of the rows and no join.

    A group's rows travel with its aggregate as one array, so this is for groups of a size that does not
    follow the facts, such as those of a mart. Rows without a key belong to no group; ties go to the smaller key.
    """
    grouped = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        value.alias("__value"), F.collect_list(F.struct(*df.columns)).alias("__rows")
    )
    top = top_rows(grouped, n, F.col("__value").desc_nulls_last(), F.col(key))
    return top.select(F.inline("__rows"))
