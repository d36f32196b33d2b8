"""Ratings-shaped tables derived from a sales and events warehouse kept as Parquet.

A line of an order becomes a rating by the ordering customer of the ordered part, the part list
becomes the catalogue, suppliers become tags and events become free-text tags. Everything here is
a row-local projection except ``ratings``, which joins order lines to orders to find the user.
"""

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns read of each table. Stating them saves a job per table to fetch the schema.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, "
    "l_discount double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
}

# How words and types of the part list read as genres.
WORD_GENRES = {
    "anvil": "Animation",
    "blue": "Crime",
    "bolt": "Fantasy",
    "cold": "Drama",
    "gear": "Action",
    "gizmo": "Sci-Fi",
    "hot": "Children",
    "large": "Comedy",
    "new": "Adventure",
    "old": "Mystery",
    "plate": "Romance",
    "red": "Documentary",
    "ring": "Thriller",
    "rod": "Musical",
    "small": "Horror",
    "widget": "War",
}
TYPE_GENRES = {"ECONOMY": "IMAX", "MEDIUM": "Western", "STANDARD": "Film-Noir"}

# All genres these tables can show: the mapped ones, the unmapped part types, and "none".
GENRES = sorted(
    {*WORD_GENRES.values(), *TYPE_GENRES.values(), "LARGE", "PROMO", "SMALL", "(no genres listed)"}
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _translate(key: Column, mapping: dict[str, str]) -> Column:
    lookup = F.create_map(*map(F.lit, chain.from_iterable(mapping.items())))
    return F.coalesce(lookup[key], key)


def epoch_seconds(ts: Column) -> Column:
    """Whole epoch seconds of a zone-less timestamp, whatever the session time zone is."""
    since = ts - F.lit("1970-01-01").cast("timestamp_ntz")
    return since.cast("interval second").cast("bigint")


def _stars() -> Column:
    """Half-star rating 0.5..5.0 from the quantity, with a slope that differs by item."""
    return (
        1 + F.floor((F.col("l_quantity") - 1) * (1 + F.col("l_partkey") % 10) / 50)
    ) / F.lit(2.0)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``userId, movieId, rating, timestamp``.

    Both join sides are plain scans, so the adaptive planner can split an oversized order key.
    """
    lines = _table(spark, sf_dir, "lineitem")
    orders = _table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        _stars().alias("rating"),
        epoch_seconds(F.col("l_shipdate")).alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movieId, title, genres``: some titles hold a comma, some have no year, some no genre."""
    key, name = F.col("p_partkey"), F.col("p_name")
    first = _translate(F.split_part(name, F.lit(" "), F.lit(1)), WORD_GENRES)
    second = _translate(F.split_part(name, F.lit(" "), F.lit(2)), WORD_GENRES)
    third = _translate(F.col("p_type"), TYPE_GENRES)
    year = F.concat(F.lit(" ("), (1920 + 2 * F.col("p_size")).cast("string"), F.lit(")"))
    article = F.when(key % 7 == 0, ", the").otherwise("")
    return _table(spark, sf_dir, "part").select(
        key.alias("movieId"),
        F.when(key % 41 == 0, name).otherwise(F.concat(name, article, year)).alias("title"),
        F.when(key % 37 == 0, "(no genres listed)")
        .when(key % 2 == 0, F.concat_ws("|", first, second, third))
        .otherwise(F.concat_ws("|", first, second))
        .alias("genres"),
    )


def genome_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movieId, tagId, relevance``."""
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("movieId"),
        F.col("l_suppkey").alias("tagId"),
        (F.col("l_discount") * 10).alias("relevance"),
    )


def genome_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tagId, tag``."""
    return _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("tagId"), F.col("s_name").alias("tag")
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``userId, movieId, tag, timestamp``."""
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("userId"),
        (F.col("event_id") % 2000).alias("movieId"),
        F.concat_ws("-", "event_type", (F.col("event_id") % 13).cast("string")).alias("tag"),
        epoch_seconds(F.col("ts")).alias("timestamp"),
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``movieId, imdbId, tmdbId``: outside identifiers of each item."""
    key = F.col("p_partkey")
    return _table(spark, sf_dir, "part").select(
        key.alias("movieId"),
        F.lpad(key.cast("string"), 7, "0").alias("imdbId"),
        (key * 3 + 1).cast("string").alias("tmdbId"),
    )
