from ratingloom.operators.ranking import popular_items, rating_count, top_rated

ITEMS = "movieId int, title string, genres string"
RATINGS = "userId int, movieId int, rating double, timestamp long"


def _ratings(spark, counts):
    rows = [(u, m, v, 0) for m, (n, v) in counts.items() for u in range(n)]
    return spark.createDataFrame(rows, RATINGS)


def test_rating_count(spark):
    assert rating_count(_ratings(spark, {1: (3, 4.0), 2: (2, 1.0)})).collect() == [(5,)]


def test_top_rated_needs_strictly_more_raters_and_a_title(spark):
    ratings = _ratings(
        spark, {1: (3, 5.0), 2: (4, 4.0), 3: (5, 4.0), 4: (9, 5.0), 5: (4, 3.125)}
    )
    items = spark.createDataFrame(
        [(1, "a", ""), (2, 'The "b", again', ""), (3, "c", ""), (5, "e", "")], ITEMS
    )
    got = [tuple(r) for r in top_rated(ratings, items, 5, 3).collect()]
    assert got == [(2, "The b, again", 4.0, 4), (3, "c", 4.0, 5), (5, "e", 3.13, 4)]
    assert [r.movieId for r in top_rated(ratings, items, 2, 3).collect()] == [2, 3]


def test_popular_items_keeps_the_threshold_itself(spark):
    ratings = _ratings(spark, {1: (2, 5.0), 2: (3, 4.0), None: (9, 1.0)})
    for hot_rows in (1_000_000, 2, 0):
        got = popular_items(ratings, 3, hot_rows=hot_rows).collect()
        assert [(r.movieId, r["count"]) for r in got] == [(2, 3)] * 3
    assert got[0].asDict().keys() == {"userId", "movieId", "rating", "timestamp", "count"}
