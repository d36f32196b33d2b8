"""Items and genres by decade of the year in the title."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.functions.catalogue import (
    NO_GENRE,
    OTHER,
    decade_label,
    genre_list,
    title_year,
)


def items_by_decade(
    items: DataFrame, first: int = 1930, last: int = 2022, *, title: str = "title"
) -> DataFrame:
    """Items with a title year from ``first`` to ``last``, with ``year`` and ``decade``."""
    year = F.col("year")
    return (
        items.withColumn("year", title_year(F.col(title)))
        .filter(year.between(first, last))
        .withColumn("decade", decade_label(year))
    )


def top_genres_per_decade(
    items: DataFrame,
    k: int = 5,
    first: int = 1930,
    last: int = 2022,
    *,
    title: str = "title",
    genres: str = "genres",
) -> DataFrame:
    """Genres with one of the ``k`` highest item counts of a decade; ties can give more than ``k``.

    Missing genres count as a genre here.
    """
    by_count = Window.partitionBy("decade").orderBy(F.col("count").desc())
    return (
        items_by_decade(items, first, last, title=title)
        .select("decade", F.explode(genre_list(F.col(genres))).alias("genre"))
        .groupBy("decade", "genre")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("rank", F.dense_rank().over(by_count))
        .filter(F.col("rank") <= k)
        .select("decade", "genre", "count")
    )


def decade_genre_share(
    items: DataFrame,
    k: int = 5,
    first: int = 1930,
    last: int = 2022,
    *,
    title: str = "title",
    genres: str = "genres",
) -> DataFrame:
    """Share of each top genre among the top genres of its decade, without missing and other."""
    within_decade = Window.partitionBy("decade")
    return (
        top_genres_per_decade(items, k, first, last, title=title, genres=genres)
        .filter(~F.col("genre").isin(NO_GENRE, OTHER))
        .withColumn("share", F.col("count") / F.sum("count").over(within_decade))
    )


def decade_genre_table(
    items: DataFrame,
    k: int = 5,
    first: int = 1930,
    last: int = 2022,
    vocabulary: Sequence[str] | None = None,
    *,
    title: str = "title",
    genres: str = "genres",
) -> DataFrame:
    """The shares as one row per decade and one column per genre, 0 where a genre is not on top.

    Genres outside a vocabulary are summed up in ``Other``. Without one, Spark first runs a job to
    list the genres.
    """
    shares = decade_genre_share(items, k, first, last, title=title, genres=genres)
    names = None
    if vocabulary:
        names = [g for g in vocabulary if g not in (NO_GENRE, OTHER)]
        known = F.col("genre").isin(*names)
        shares = shares.withColumn("genre", F.when(known, F.col("genre")).otherwise(OTHER))
        names.append(OTHER)
    return (
        shares.groupBy("decade")
        .pivot("genre", names)
        .agg(F.sum("share"))
        .fillna(0.0)
        .orderBy("decade")
    )
