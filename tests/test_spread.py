from ratingloom.operators.spread import (
    genre_combo_min_range,
    genre_combo_rating_range,
    item_min_range,
    item_rating_range,
    rating_range_histogram,
)

RATINGS = "movieId int, rating double"
NAN = float("nan")


def _data(spark):
    ratings = spark.createDataFrame(
        [(1, 3.0), (1, 3.0), (2, 1.0), (2, 1.5), (3, 0.5), (3, 5.0), (4, 2.0), (4, 2.5)]
        + [(None, 1.0), (None, 5.0)],
        RATINGS,
    )
    items = spark.createDataFrame(
        [(1, "a", "Drama"), (2, "b", "Drama|War"), (3, "c", "War"), (4, "d", "Drama")],
        "movieId int, title string, genres string",
    )
    return ratings, items


def test_zero_ranges_are_left_out_of_the_smallest(spark):
    ratings, items = _data(spark)
    rows = item_rating_range(ratings, items, 2).collect()
    assert [(r.movieId, r.rating_diff, r.title) for r in rows] == [(2, 0.5, "b"), (4, 0.5, "d")]
    assert [r.movieId for r in item_min_range(ratings).collect()] == [2]


def test_items_without_a_title_use_up_places(spark):
    ratings, items = _data(spark)
    rows = item_rating_range(ratings, items.filter("movieId <> 2"), 2).collect()
    assert [r.movieId for r in rows] == [4]


def test_combinations_span_their_items(spark):
    ratings, items = _data(spark)
    rows = genre_combo_rating_range(ratings, items, 9).collect()
    assert [tuple(r) for r in rows] == [
        ("Drama|War", 1.5, 1.0, 0.5),
        ("Drama", 3.0, 2.0, 1.0),
        ("War", 5.0, 0.5, 4.5),
    ]
    assert [r.genres for r in genre_combo_min_range(ratings, items).collect()] == ["Drama|War"]


def test_histogram_counts_zero_ranges_and_labels_by_upper_bound(spark):
    ratings, _ = _data(spark)
    odd = spark.createDataFrame(
        [(5, None), (6, NAN), (6, 1.0), (7, 0.0), (7, 9.0), (8, 1.0), (8, 1.6)], RATINGS
    )
    rows = rating_range_histogram(ratings.union(odd)).collect()
    assert [tuple(r) for r in rows] == [("0", 1), ("0.5", 2), ("1", 1), ("4.5", 1), ("5", 3)]
