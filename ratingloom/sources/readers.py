"""Table readers: CSV or Parquet, on any path Hadoop can resolve, always with a fixed schema."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingloom import schemas

# Quotes inside a quoted field are doubled, so the quote is its own escape character.
# Spark would take columns by position; without enforcement it compares the header with the schema.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "enforceSchema": False,
}


def read_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    fmt: str = "csv",
    *,
    mode: str = "PERMISSIVE",
    bad_records: str | None = None,
) -> DataFrame:
    """Read one table. A CSV header must name the columns of the schema, in every file.

    In the ``PERMISSIVE`` mode a field that does not parse is NULL, and ``bad_records`` names a
    column for the text of such lines; ``DROPMALFORMED`` and ``FAILFAST`` are Spark's.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, mode=mode)
        if bad_records:
            schema = T.StructType([*schema.fields, T.StructField(bad_records, T.StringType())])
            reader = reader.option("columnNameOfCorruptRecord", bad_records)
    return reader.schema(schema).load(path)


def read_ratings(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.RATINGS, fmt)


def read_movies(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.MOVIES, fmt)


def read_tags(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.TAGS, fmt)


def read_genome_tags(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.GENOME_TAGS, fmt)


def read_genome_scores(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.GENOME_SCORES, fmt)


def read_links(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    return read_table(spark, path, schemas.LINKS, fmt)


def read_ratings_mode(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", *, index_column: bool = False
) -> DataFrame:
    """Ratings with the modes of item and user.

    ``index_column`` is for CSV whose first column is a row number without a name; it is left out.
    """
    if fmt != "csv" or not index_column:
        return read_table(spark, path, schemas.RATINGS_MODE, fmt)
    # Columns are taken by the names of the header, which is all that is read to find them.
    texts = spark.read.options(**CSV_OPTIONS).csv(path)
    wanted = schemas.RATINGS_MODE
    if texts.columns[1:] != wanted.names:
        raise ValueError(f"expected an index and {wanted.names}, found {texts.columns}")
    return texts.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in wanted])


def preview(df: DataFrame, n: int = 3, order_by: list[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows in ``order_by`` order, or any ``n`` rows if no order is given.

    The ordered form is a top-k, never a full sort; the unordered one stops after the first files.
    """
    if order_by:
        df = df.orderBy(*[F.col(c) if isinstance(c, str) else c for c in order_by])
    return df.limit(n)
