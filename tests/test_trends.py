import pytest

from ratingloom.operators.trends import (
    cumulative_trend,
    top_faller,
    top_riser,
    trend_change,
    yearly_ratings,
)

RATINGS = "movieId int, rating double, timestamp long"
YEAR = 31_556_952


def _ratings(spark, rows):
    """Rows of (item, year, count, rating)."""
    flat = [
        (m, v, int((y - 1970) * YEAR + YEAR / 2)) for m, y, n, v in rows for _ in range(n)
    ]
    return spark.createDataFrame(flat, RATINGS)


def test_years_are_utc_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    edge = spark.createDataFrame([(1, 3.0, 915148799), (1, 3.0, 915148800), (1, 2.0, -1)], RATINGS)
    try:
        for other in ("UTC", "Asia/Tokyo", "America/Los_Angeles"):
            spark.conf.set("spark.sql.session.timeZone", other)
            got = {r.Year: r.yearly_count for r in yearly_ratings(edge).collect()}
            assert got == {1998: 1, 1999: 1, 1969: 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_small_years_count_but_are_not_listed(spark):
    ratings = _ratings(spark, [(1, 2000, 3, 1.0), (1, 2001, 3, 2.0), (1, 2002, 10, 4.0)])
    rows = cumulative_trend(ratings, 1, 5).orderBy("Year").collect()
    assert [(r.Year, r.yearly_count, r.cumulative_count) for r in rows] == [
        (2001, 3, 6),
        (2002, 10, 16),
    ]
    assert [r.cumulative_avg_rating for r in rows] == [1.5, 49 / 16]


def test_popularity_counts_all_years_and_keeps_the_threshold(spark):
    ratings = _ratings(spark, [(1, 2000, 3, 1.0), (1, 2001, 3, 2.0), (2, 2000, 5, 2.0)])
    assert {r.movieId for r in yearly_ratings(ratings, 6).collect()} == {1}
    assert {r.movieId for r in yearly_ratings(ratings).collect()} == {1, 2}


def test_change_is_relative_to_the_first_listed_year(spark):
    ratings = _ratings(
        spark, [(1, 2000, 2, 2.0), (1, 2001, 2, 4.0), (1, 2002, 4, 1.0), (2, 2000, 2, 0.0)]
    )
    rows = trend_change(ratings, 1, 1).orderBy("movieId", "Year").collect()
    assert [(r.Year, r.first_rating, r.last_rating, r.diff) for r in rows] == [
        (2000, 2.0, 2.0, 0.0),
        (2001, 2.0, 3.0, 0.5),
        (2002, 2.0, 2.0, 0.0),
        (2000, 0.0, 0.0, None),
    ]


@pytest.fixture
def trio(spark):
    return _ratings(
        spark,
        [
            (1, 2000, 2, 2.0),
            (1, 2001, 2, 4.0),
            (1, 2002, 9, 1.0),
            (2, 2000, 2, 4.0),
            (2, 2001, 2, 5.0),
            (3, 2000, 2, 0.0),
        ],
    )


def test_riser_looks_at_any_year_and_returns_the_whole_series(spark, trio):
    items = spark.createDataFrame([(1, "one"), (2, "two")], "movieId int, title string")
    rows = top_riser(trio, items, 1, 1).collect()
    assert [(r.movieId, r.title, r.Year) for r in rows] == [
        (1, "one", 2000),
        (1, "one", 2001),
        (1, "one", 2002),
    ]


def test_faller_keeps_an_item_without_a_title(spark, trio):
    items = spark.createDataFrame([(2, "two")], "movieId int, title string")
    rows = top_faller(trio, items, 1, 1).collect()
    assert {(r.movieId, r.title) for r in rows} == {(1, None)}
    assert len(rows) == 3
