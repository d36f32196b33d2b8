"""How the mean rating of an item moves over the years.

Ratings are reduced to one row per item and year first, inside the map tasks. Everything after
that, including the popularity threshold, runs on those few rows per item.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.scales import utc_year

SERIES = (
    "yearly_total_rating",
    "yearly_count",
    "cumulative_total_rating",
    "cumulative_count",
    "cumulative_avg_rating",
)


def yearly_ratings(
    ratings: DataFrame,
    min_count: int = 0,
    *,
    item: str = "movieId",
    value: str = "rating",
    ts: str = "timestamp",
) -> DataFrame:
    """Sum and count of ratings per item and year, for items with at least ``min_count`` ratings."""
    yearly = ratings.groupBy(item, utc_year(F.col(ts)).alias("Year")).agg(
        F.sum(value).alias("yearly_total_rating"),
        F.count(value).alias("yearly_count"),
        F.count(F.lit(1)).alias("__rows"),
    )
    if min_count > 0:
        whole_item = Window.partitionBy(item)
        yearly = yearly.withColumn("__rows", F.sum("__rows").over(whole_item)).filter(
            (F.col("__rows") >= min_count) & F.col(item).isNotNull()
        )
    return yearly.drop("__rows")


def cumulative_trend(
    ratings: DataFrame,
    min_count: int = 5000,
    min_cumulative: int = 100,
    *,
    item: str = "movieId",
    value: str = "rating",
    ts: str = "timestamp",
) -> DataFrame:
    """Running sum, count and mean per item by year.

    Years before an item reaches ``min_cumulative`` ratings count towards the running values but
    are not listed.
    """
    so_far = Window.partitionBy(item).orderBy("Year")
    return (
        yearly_ratings(ratings, min_count, item=item, value=value, ts=ts)
        .withColumn("cumulative_total_rating", F.sum("yearly_total_rating").over(so_far))
        .withColumn("cumulative_count", F.sum("yearly_count").over(so_far))
        .filter(F.col("cumulative_count") >= min_cumulative)
        .withColumn(
            "cumulative_avg_rating",
            F.try_divide("cumulative_total_rating", "cumulative_count"),
        )
        .select(item, "Year", *SERIES)
    )


def _with_change(trend: DataFrame, item: str) -> DataFrame:
    so_far = Window.partitionBy(item).orderBy("Year")
    last = F.col("cumulative_avg_rating")
    return trend.withColumn("first_rating", F.first(last).over(so_far)).withColumn(
        "diff", F.try_divide(last - F.col("first_rating"), F.col("first_rating"))
    )


def trend_change(
    ratings: DataFrame,
    min_count: int = 5000,
    min_cumulative: int = 100,
    *,
    item: str = "movieId",
    value: str = "rating",
    ts: str = "timestamp",
) -> DataFrame:
    """Relative change from the first listed running mean to that of each year."""
    trend = cumulative_trend(
        ratings, min_count, min_cumulative, item=item, value=value, ts=ts
    )
    return _with_change(trend, item).select(
        item, "Year", "first_rating", F.col("cumulative_avg_rating").alias("last_rating"), "diff"
    )


def _extreme(
    ratings: DataFrame,
    items: DataFrame,
    order: Column,
    min_count: int,
    min_cumulative: int,
    item: str,
    value: str,
    ts: str,
    title: str,
) -> DataFrame:
    trend = cumulative_trend(
        ratings, min_count, min_cumulative, item=item, value=value, ts=ts
    )
    # One row, so the broadcast does not grow with the data.
    winner = F.broadcast(
        _with_change(trend, item)
        .filter(F.col("diff").isNotNull())
        .orderBy(order, item, "Year")
        .limit(1)
        .select(item)
    )
    named = items.join(winner, item, "left_semi").select(item, title)
    return (
        trend.join(winner, item, "left_semi")
        .join(named, item, "left")
        .select(item, title, "Year", *SERIES)
        .sortWithinPartitions("Year")
    )


def top_riser(
    ratings: DataFrame,
    items: DataFrame,
    min_count: int = 5000,
    min_cumulative: int = 100,
    *,
    item: str = "movieId",
    value: str = "rating",
    ts: str = "timestamp",
    title: str = "title",
) -> DataFrame:
    """Title and full series of the item whose mean rose most, comparing any year to its first."""
    order = F.col("diff").desc()
    return _extreme(
        ratings, items, order, min_count, min_cumulative, item, value, ts, title
    )


def top_faller(
    ratings: DataFrame,
    items: DataFrame,
    min_count: int = 5000,
    min_cumulative: int = 100,
    *,
    item: str = "movieId",
    value: str = "rating",
    ts: str = "timestamp",
    title: str = "title",
) -> DataFrame:
    """Title and full series of the item whose mean fell most, comparing any year to its first."""
    order = F.col("diff").asc()
    return _extreme(
        ratings, items, order, min_count, min_cumulative, item, value, ts, title
    )
