from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratingloom.sources import readers, warehouse, writers


def test_quoted_titles_keep_commas_and_quotes(spark, tmp_path):
    path = tmp_path / "movies.csv"
    path.write_text(
        'movieId,title,genres\n1,"American President, The (1995)",Comedy|Drama\n'
        '2,"The ""Burbs"" (1989)",Comedy\n3,Café (1990),(no genres listed)\nx,bad id,War\n',
        encoding="utf-8",
    )
    rows = [tuple(r) for r in readers.read_movies(spark, str(path)).collect()]
    assert rows == [
        (1, "American President, The (1995)", "Comedy|Drama"),
        (2, 'The "Burbs" (1989)', "Comedy"),
        (3, "Café (1990)", "(no genres listed)"),
        (None, "bad id", "War"),
    ]


def test_each_file_has_its_header_skipped(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"r{i}.csv").write_text(
            f"userId,movieId,rating,timestamp\n{i},7,3.5,1147880044\n"
        )
    got = readers.read_ratings(spark, str(tmp_path))
    assert got.dtypes == [
        ("userId", "bigint"),
        ("movieId", "bigint"),
        ("rating", "double"),
        ("timestamp", "bigint"),
    ]
    assert {tuple(r) for r in got.collect()} == {(i, 7, 3.5, 1147880044) for i in range(3)}


@pytest.mark.parametrize(
    ("reader", "header", "line", "row"),
    [
        (readers.read_tags, "userId,movieId,tag,timestamp", "1,2,dark hero,5", (1, 2, "dark hero", 5)),
        (readers.read_genome_tags, "tagId,tag", "3,007", (3, "007")),
        (readers.read_genome_scores, "movieId,tagId,relevance", "1,3,0.25", (1, 3, 0.25)),
        (readers.read_links, "movieId,imdbId,tmdbId", "1,0114709,862", (1, "0114709", "862")),
        (
            readers.read_ratings_mode,
            "userId,movieId,rating,mode_movie,mode_user",
            "1,2,3.5,4.0,3.0",
            (1, 2, 3.5, 4.0, 3.0),
        ),
    ],
)
def test_other_tables(spark, tmp_path, reader, header, line, row):
    path = tmp_path / "t.csv"
    path.write_text(f"{header}\n{line}\n")
    assert [tuple(r) for r in reader(spark, str(path)).collect()] == [row]


def test_csv_round_trip_in_one_file(spark, tmp_path):
    out = str(tmp_path / "out")
    movies = warehouse.movies(spark, "/root/testdata/sf0.001").selectExpr(
        "movieId", "title || ' \"x\"' title", "genres"
    )
    writers.write_csv(movies.repartition(4), out, single_file=True)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert readers.read_movies(spark, out).exceptAll(movies).isEmpty()
    assert readers.read_movies(spark, out).count() == 200


def test_write_modes(spark, tmp_path):
    out = str(tmp_path / "out")
    one = spark.range(1)
    writers.write_csv(one, out)
    with pytest.raises(Exception, match="(?i)already exists"):
        writers.write_csv(one, out)
    writers.write_csv(spark.range(2), out, mode="overwrite")
    assert spark.read.csv(out, header=True).count() == 2


def test_parquet_round_trip_with_partitions(spark, tmp_path):
    out = str(tmp_path / "p")
    ratings = warehouse.ratings(spark, "/root/testdata/sf0.001")
    writers.write_parquet(ratings, out, partition_by=["rating"])
    back = spark.read.parquet(out).select(*ratings.columns)
    assert back.exceptAll(ratings).isEmpty() and back.count() == 6000
    plan = spark.read.parquet(out).filter("rating = 5.0")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(rating" in plan


def test_preview(spark):
    df = spark.range(10)
    assert readers.preview(df).count() == 3
    assert [r.id for r in readers.preview(df, 2, [df.id.desc()]).collect()] == [9, 8]
    assert [r.id for r in readers.preview(df, 2, ["id"]).collect()] == [0, 1]


def test_adapters_do_not_depend_on_the_session_zone(spark):
    d = "/root/testdata/sf0.001"
    zone = spark.conf.get("spark.sql.session.timeZone")
    want = Counter(warehouse.ratings(spark, d).collect())
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert Counter(warehouse.ratings(spark, d).collect()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_epoch_seconds_cut_fractions_off(spark):
    times = ["1970-01-01 00:00:00", "2024-02-29 23:59:59.999999", "1969-12-31 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(
        warehouse.epoch_seconds(F.col("t").cast("timestamp_ntz")).alias("s")
    )
    assert [r.s for r in df.collect()] == [0, 1709251199, -86400]


def test_wide_ids_and_bad_records(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("userId,movieId,rating,timestamp\n3000000000,7,3.5,5\nx,7,oops,5\n")
    rows = readers.read_table(
        spark, str(path), readers.schemas.RATINGS, bad_records="line"
    ).collect()
    assert [(r.userId, r.rating, r.line) for r in rows] == [
        (3000000000, 3.5, None),
        (None, None, "x,7,oops,5"),
    ]
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_table(spark, str(path), readers.schemas.RATINGS, mode="FAILFAST").collect()


def test_header_must_fit(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text(",userId,movieId,rating,mode_movie,mode_user\n0,11,22,3.5,4.0,3.0\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_ratings_mode(spark, str(path)).collect()
    rows = readers.read_ratings_mode(spark, str(path), index_column=True)
    assert [tuple(r) for r in rows.collect()] == [(11, 22, 3.5, 4.0, 3.0)]
    with pytest.raises(ValueError, match="expected an index"):
        readers.read_ratings_mode(spark, _swapped(tmp_path), index_column=True)


def _swapped(folder):
    path = folder / "s.csv"
    path.write_text(",movieId,userId,rating,mode_movie,mode_user\n0,11,22,3.5,4.0,3.0\n")
    return str(path)
