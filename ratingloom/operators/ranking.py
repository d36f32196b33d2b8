"""Counting ratings and ranking items by them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.plans.hot_keys import HOT_ROWS, KeyStats, attach


def rating_count(ratings: DataFrame) -> DataFrame:
    """Number of ratings, one row."""
    return ratings.agg(F.count(F.lit(1)).alias("rating_count"))


def top_rated(
    ratings: DataFrame,
    items: DataFrame,
    k: int = 5,
    min_raters: int = 3000,
    *,
    item: str = "movieId",
    value: str = "rating",
    title: str = "title",
) -> DataFrame:
    """The ``k`` titled items with the best mean rating among those with more than ``min_raters``."""
    per_item = (
        ratings.groupBy(item)
        .agg(F.avg(value).alias("average_rating"), F.count(value).alias("raters"))
        .filter(F.col("raters") > min_raters)
    )
    return (
        per_item.join(items.select(item, title), item)
        .orderBy(F.col("average_rating").desc(), item)
        .limit(k)
        .select(
            item,
            F.replace(F.col(title), F.lit('"'), F.lit("")).alias(title),
            F.round("average_rating", 2).alias("average_rating"),
            "raters",
        )
    )


def popular_items(
    ratings: DataFrame,
    min_count: int = 5000,
    *,
    item: str = "movieId",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Ratings of the items that have at least ``min_count`` of them, with that ``count``."""
    per_item = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("count"))
    popular = per_item.filter(F.col("count") >= min_count)
    keys = [KeyStats(item, popular.withColumn("__rows", F.col("count")), "__rows")]
    return attach(ratings, keys, hot_rows).filter(
        F.col("count").isNotNull()
    )
