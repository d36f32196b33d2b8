import pytest

from ratingloom.operators.decades import (
    decade_genre_share,
    decade_genre_table,
    items_by_decade,
    top_genres_per_decade,
)

NONE = "(no genres listed)"


def _items(spark, rows):
    return spark.createDataFrame(rows, "title string, genres string")


def test_years_and_bounds(spark):
    titles = [
        "Plain",
        "Early (1929)",
        "First (1930)",
        "Last (2022)",
        "Late (2023)",
        "Two (1950) versions (1960)",
        "Comma, the (1999)",
        "Long (19999)",
        None,
    ]
    rows = items_by_decade(_items(spark, [(t, "Drama") for t in titles])).collect()
    assert {(r.title, r.year, r.decade) for r in rows} == {
        ("First (1930)", 1930, "1930s"),
        ("Last (2022)", 2022, "2020s"),
        ("Two (1950) versions (1960)", 1950, "1950s"),
        ("Comma, the (1999)", 1999, "1990s"),
    }


@pytest.fixture
def ranked(spark):
    rows = [("x (1991)", "Drama")] * 3 + [("x (1992)", NONE)] * 2
    rows += [("x (1993)", g) for g in ("War", "Crime", "Other")] + [("y (2001)", NONE)]
    return _items(spark, rows)


def test_ties_share_a_rank(spark, ranked):
    rows = {tuple(r) for r in top_genres_per_decade(ranked, 3).collect()}
    assert rows == {
        ("1990s", "Drama", 3),
        ("1990s", NONE, 2),
        ("1990s", "War", 1),
        ("1990s", "Crime", 1),
        ("1990s", "Other", 1),
        ("2000s", NONE, 1),
    }
    assert top_genres_per_decade(ranked, 2).count() == 3


def test_shares_leave_out_missing_and_other(spark, ranked):
    rows = {(r.decade, r.genre): r.share for r in decade_genre_share(ranked, 3).collect()}
    assert rows == {
        ("1990s", "Drama"): 0.6,
        ("1990s", "War"): 0.2,
        ("1990s", "Crime"): 0.2,
    }


def test_table_fills_gaps_with_zero(spark, ranked):
    (found,) = decade_genre_table(ranked, 3).collect()
    assert found.asDict() == {"decade": "1990s", "Crime": 0.2, "Drama": 0.6, "War": 0.2}
    (row,) = decade_genre_table(ranked, 3, vocabulary=["Drama", "Comedy"]).collect()
    assert (row.decade, row.Drama, row.Comedy, row.Other) == ("1990s", 0.6, 0.0, 0.4)
    assert sum(v for k, v in row.asDict().items() if k != "decade") == pytest.approx(1)
