from collections import Counter

import pytest

from ratingloom.operators.features import (
    avg_features,
    feature_vectors,
    mode_features,
    random_split,
    rating_features,
    rating_vectors,
    train_test_split,
)
from ratingloom.plans import hot_keys
from ratingloom.sources import warehouse

RATINGS = "userId int, movieId int, rating double, timestamp long"
NAN = float("nan")


def _ratings(spark, rows):
    return spark.createDataFrame([(u, m, v, 0) for u, m, v in rows], RATINGS)


def test_mode_ties_take_the_smallest(spark):
    values = [5.0, 5.0, 3.0, 3.0, 1.0, None, None, None, NAN, NAN, NAN]
    rows = mode_features(_ratings(spark, [(i, 1, v) for i, v in enumerate(values)])).collect()
    assert {r.mode_movie for r in rows} == {3.0}
    users = {r.userId: r.mode_user for r in rows}
    assert (users[0], users[4], users[5], users[8]) == (5.0, 1.0, None, None)
    assert len(rows) == len(values)


def test_averages_skip_null_and_keep_every_rating(spark):
    ratings = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0), (2, 1, 3.0), (2, 1, 3.0), (3, 1, None)])
    rows = avg_features(ratings).collect()
    assert Counter((r.userId, r.movieId, r.movie_average, r.user_average) for r in rows) == {
        (1, 1, 10 / 3, 2.5): 1,
        (1, 2, 1.0, 2.5): 1,
        (2, 1, 10 / 3, 3.0): 2,
        (3, 1, 10 / 3, None): 1,
    }


def test_statistics_of_the_training_part_only(spark):
    train = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0), (2, 1, 4.0)])
    test = _ratings(spark, [(1, 1, 5.0), (9, 1, 5.0), (1, 9, 5.0)])
    rows = {(r.userId, r.movieId): r for r in avg_features(test, train).collect()}
    assert (rows[1, 1].movie_average, rows[1, 1].user_average) == (4.0, 2.5)
    assert (rows[9, 1].movie_average, rows[9, 1].user_average) == (4.0, 3.0)
    assert (rows[1, 9].movie_average, rows[1, 9].user_average) == (3.0, 2.5)
    modes = {(r.userId, r.movieId): r for r in mode_features(test, train).collect()}
    assert (modes[1, 1].mode_movie, modes[1, 1].mode_user) == (4.0, 1.0)
    assert modes[9, 1].mode_user == 3.0


ITEMS = [(1, "a", "Crime|War"), (2, "b", "(no genres listed)"), (9, "z", "Drama")]


def test_flat_features_and_vectors(spark):
    items = spark.createDataFrame(ITEMS, "movieId int, title string, genres string")
    ratings = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0), (2, 3, 4.0)])
    flat = rating_features(ratings, items, ["Crime", "War", "(no genres listed)"])
    assert flat.columns == [
        "movieId",
        "userId",
        "rating",
        "mode_movie",
        "mode_user",
        "movie_average",
        "user_average",
        "Crime",
        "War",
        "Other",
    ]
    rows = {r.movieId: tuple(r)[7:] for r in flat.collect()}
    assert rows == {1: (1, 1, 0), 2: (0, 0, 0), 3: (0, 0, 0)}
    vectors = {r.movieId: list(r.features) for r in feature_vectors(flat).collect()}
    assert vectors[1] == [4.0, 1.0, 4.0, 2.5, 1.0, 1.0, 0.0]


def test_unseen_items_keep_their_genres(spark):
    items = spark.createDataFrame(ITEMS, "movieId int, title string, genres string")
    train = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0)])
    test = _ratings(spark, [(1, 9, 5.0), (7, 8, 5.0)])
    for hot_rows in (1_000_000, 0):
        flat = rating_features(test, items, ["Drama", "War"], train, hot_rows=hot_rows)
        rows = {r.movieId: tuple(r)[3:] for r in flat.collect()}
        assert rows == {9: (2.5, 1.0, 2.5, 2.5, 1, 0, 0), 8: (2.5, 2.5, 2.5, 2.5, 0, 0, 0)}


def test_null_items_on_both_sides_leave_hot_keys_alone(spark, monkeypatch):
    items = spark.createDataFrame(
        [*ITEMS, (None, "n", "War"), (3, "c", "War")], "movieId int, title string, genres string"
    )
    train = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0), (2, 3, 3.0), (2, None, 5.0), (None, 1, 2.0)])
    test = _ratings(spark, [(u, m, 1.0) for u in (1, 2, None) for m in (1, 2, 3, 9, None)])
    names = ["Crime", "War", "Drama"]
    plain = Counter(rating_features(test, items, names, train).collect())
    for bound in (1, 3, 10_000):
        monkeypatch.setattr(hot_keys, "HOT_KEYS", bound)
        got = rating_features(test, items, names, train, hot_rows=0)
        assert Counter(got.collect()) == plain


def test_training_means_leave_the_own_rating_out(spark):
    items = spark.createDataFrame(ITEMS, "movieId int, title string, genres string")
    train = _ratings(spark, [(1, 1, 4.0), (2, 1, 2.0), (1, 2, 3.0)])
    flat = rating_features(train, items, ["War"], leave_one_out=True)
    rows = {(r.userId, r.movieId): (r.movie_average, r.user_average) for r in flat.collect()}
    assert rows == {(1, 1): (2.0, 3.0), (2, 1): (4.0, 3.0), (1, 2): (3.0, 4.0)}


def test_discovered_vocabulary_gives_the_same_rows(spark, sf_dir):
    d = "/root/testdata/sf0.001"
    ratings, items = warehouse.ratings(spark, d), warehouse.movies(spark, d)
    known = rating_features(ratings, items, warehouse.GENRES)
    found = rating_features(ratings, items, None)
    assert sorted(known.columns) == sorted([*found.columns, "Other"])
    assert known.filter("Other > 0").isEmpty()
    assert known.select(*found.columns).exceptAll(found).isEmpty()


@pytest.mark.parametrize("operator", [mode_features, avg_features])
def test_hot_keys_change_nothing(spark, operator):
    d = "/root/testdata/sf0.001"
    ratings = warehouse.ratings(spark, d)
    plain = operator(ratings).collect()
    for hot_rows in (0, 30, 40):
        assert Counter(operator(ratings, hot_rows=hot_rows).collect()) == Counter(plain)


def test_key_split_is_a_partition_and_stable(spark, sf_dir):
    ratings = warehouse.ratings(spark, sf_dir)
    marked = train_test_split(ratings)
    train, test = marked.filter("is_train"), marked.filter("not is_train")
    assert train.count() + test.count() == ratings.count()
    assert 0.68 < train.count() / ratings.count() < 0.72
    again = train_test_split(ratings.repartition(3, "rating")).filter("is_train")
    assert train.exceptAll(again).isEmpty()


def test_key_split_places_incomplete_rows(spark):
    odd = spark.createDataFrame([(None, 1, 1.0, 0), (1, None, 1.0, None), (-7, -3, 1.0, -5)], RATINGS)
    assert {r.is_train for r in train_test_split(odd).collect()} <= {True, False}


def test_random_split_is_complete_in_any_partitioning(spark, sf_dir):
    ratings = warehouse.ratings(spark, sf_dir)
    train = random_split(ratings.repartition(8, "userId"))[0]
    test = random_split(ratings.repartition(5, "rating"))[1]
    assert train.count() + test.count() == ratings.count()
    assert 0.68 < train.count() / ratings.count() < 0.72
    assert train.intersect(test).isEmpty()
    assert random_split(ratings, seed=1)[0].exceptAll(train).count() > 1_000
    assert sum(p.count() for p in random_split(ratings, (1, 2, 3))) == ratings.count()


def test_key_split_is_fair_to_ids_in_steps(spark):
    rows = spark.range(20_000).selectExpr(
        "id * 10 as userId", "id % 7 * 100 as movieId", "1.0 as rating", "0L as timestamp"
    )
    assert 0.68 < train_test_split(rows).filter("is_train").count() / 20_000 < 0.72


def test_vectors_of_packed_indicators_are_those_of_the_flat_features(spark, monkeypatch):
    """Equal to assembling every column, for unseen, repeated, NULL and hot keys."""
    items = spark.createDataFrame([*ITEMS, (None, "n", "War")], "movieId int, title string, genres string")
    train = _ratings(spark, [(1, 1, 4.0), (1, 2, 1.0), (1, 2, 1.0), (2, 3, 3.0), (2, None, 5.0)])
    test = _ratings(spark, [(u, m, 1.0) for u in (1, 7, None) for m in (1, 2, 3, 9, 11, None)])
    for names in (["Crime", "War", "Drama"], None):
        for part, fit_on in ((train, None), (test, train)):
            for hot_rows in (1_000_000, 0):
                more = {"hot_rows": hot_rows, "leave_one_out": fit_on is None}
                flat = feature_vectors(rating_features(part, items, names, fit_on, **more))
                packed = rating_vectors(part, items, names, fit_on, **more)
                want = flat.select("movieId", "userId", "rating", "features").collect()
                assert Counter(packed.collect()) == Counter(want)


def test_vectors_without_any_genre(spark):
    items = spark.createDataFrame([], "movieId int, title string, genres string")
    found = rating_vectors(_ratings(spark, [(1, 1, 4.0), (1, 2, 2.0)]), items).collect()
    assert {r.movieId: list(r.features) for r in found} == {1: [4, 2, 4, 3], 2: [2, 2, 2, 3]}


def test_ratings_meet_one_column_of_indicators(spark):
    items = spark.createDataFrame(ITEMS, "movieId int, title string, genres string")
    found = rating_vectors(_ratings(spark, [(1, 1, 4.0)]), items, ["Crime", "War"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "__cold0___indicators" in plan and "__cold0_Crime" not in plan
