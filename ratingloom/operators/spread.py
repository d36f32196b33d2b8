"""Distance between the best and the worst rating of items and genre combinations."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.functions.scales import SPREAD_BOUNDS, upper_bound_label


def _spread(df: DataFrame, key: str, best: str, worst: str) -> DataFrame:
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(best).alias("best_rating"), F.min(worst).alias("worst_rating"))
    )


def _with_diff(spread: DataFrame) -> DataFrame:
    return spread.withColumn(
        "rating_diff", F.abs(F.col("best_rating") - F.col("worst_rating"))
    )


def _smallest(spread: DataFrame, key: str, k: int) -> DataFrame:
    return (
        _with_diff(spread).filter(F.col("rating_diff") > 0).orderBy("rating_diff", key).limit(k)
    )


def genre_combo_rating_range(
    ratings: DataFrame,
    items: DataFrame,
    k: int = 50,
    *,
    item: str = "movieId",
    value: str = "rating",
    genres: str = "genres",
) -> DataFrame:
    """The ``k`` genre combinations (unsplit genre strings) with the smallest non-zero range.

    The range of a combination is that of its items' extremes, so ratings are reduced to one row
    per item before they meet the catalogue.
    """
    per_item = _spread(ratings, item, value, value)
    combos = per_item.join(items.select(item, genres), item)
    return _smallest(_spread(combos, genres, "best_rating", "worst_rating"), genres, k)


def genre_combo_min_range(
    ratings: DataFrame,
    items: DataFrame,
    *,
    item: str = "movieId",
    value: str = "rating",
    genres: str = "genres",
) -> DataFrame:
    """The genre combination with the smallest non-zero range."""
    return genre_combo_rating_range(ratings, items, 1, item=item, value=value, genres=genres)


def item_rating_range(
    ratings: DataFrame,
    items: DataFrame,
    k: int = 50,
    *,
    item: str = "movieId",
    value: str = "rating",
) -> DataFrame:
    """The ``k`` items with the smallest non-zero range, with their catalogue columns."""
    smallest = _smallest(_spread(ratings, item, value, value), item, k)
    return items.join(smallest, item).orderBy("rating_diff", item)


def item_min_range(
    ratings: DataFrame, *, item: str = "movieId", value: str = "rating"
) -> DataFrame:
    """The item with the smallest non-zero range."""
    return _smallest(_spread(ratings, item, value, value), item, 1)


def rating_range_histogram(
    ratings: DataFrame,
    bounds: Sequence[float] = SPREAD_BOUNDS,
    *,
    item: str = "movieId",
    value: str = "rating",
) -> DataFrame:
    """Items per range, labelled by the smallest bound that is not below it; zero counts too."""
    label = upper_bound_label(F.col("rating_diff"), bounds)
    return (
        _with_diff(_spread(ratings, item, value, value))
        .groupBy(label.alias("rating_diff_bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("rating_diff_bin")
    )
