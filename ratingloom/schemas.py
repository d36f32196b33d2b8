"""Fixed schemas of the input tables.

Every reader takes one of these, so no file is scanned twice to infer types.
"""

from pyspark.sql import types as T

# File layouts of the public ratings dataset.
RATINGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

TAGS = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("tag", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

GENOME_TAGS = T.StructType(
    [
        T.StructField("tagId", T.LongType()),
        T.StructField("tag", T.StringType()),
    ]
)

GENOME_SCORES = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("tagId", T.LongType()),
        T.StructField("relevance", T.DoubleType()),
    ]
)

LINKS = T.StructType(
    [
        T.StructField("movieId", T.LongType()),
        T.StructField("imdbId", T.StringType()),
        T.StructField("tmdbId", T.StringType()),
    ]
)

RATINGS_MODE = T.StructType(
    [
        T.StructField("userId", T.LongType()),
        T.StructField("movieId", T.LongType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("mode_movie", T.DoubleType()),
        T.StructField("mode_user", T.DoubleType()),
    ]
)
