"""Every registered query against DuckDB on the same tables, value by value."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

# Optional modules bring tests of their own.
ORACLE = {n: q for n, q in registry.oracle_sql().items() if n not in registry.OPTIONAL_QUERIES}
QUERIES = {n: q for n, q in registry.queries().items() if n not in registry.OPTIONAL_QUERIES}
NOT_SQL = {
    "als_predictions",
    "rf_predictions",
    "linreg_predictions",
    "tune_als",
    "tuned_als_predictions",
    "model_comparison",
}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(x):
    if isinstance(x, float) and not math.isnan(x):
        return round(x, 12) + 0.0
    return x


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def test_only_fitted_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLE) == NOT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir)
    answer = duck.execute(ORACLE[name])
    names = [column[0] for column in answer.description]
    assert sorted(got.columns) == sorted(names)
    want = _rows(names, answer.fetchall())
    have = _rows(got.columns, got.collect())
    assert have == want, (list((have - want).items())[:3], list((want - have).items())[:3])
    assert sum(want.values()) > 0


KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_types(name, spark, sf_dir, duck):
    got = dict(QUERIES[name](spark, sf_dir).dtypes)
    described = duck.execute(f"describe {ORACLE[name]}").fetchall()
    assert {c: KINDS[t] for c, t in got.items()} == {row[0]: row[1] for row in described}


def test_rating_needs_its_order(spark, duck, tmp_path, sf_dir):
    """An orphan line is no rating, and a repeated order key makes two, as in the statement."""
    for name in ("part", "supplier", "events"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    duck.execute(
        f"copy (select * from lineitem where l_orderkey < 400 union all select * replace "
        f"(-5 as l_orderkey) from lineitem where l_orderkey < 100) to '{tmp_path}/lineitem.parquet'"
    )
    duck.execute(
        f"copy (select * from orders union all select * from orders where o_orderkey < 200) "
        f"to '{tmp_path}/orders.parquet'"
    )
    con = duckdb.connect()
    for name in ("lineitem", "orders", "part", "supplier", "events"):
        con.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet'")
    for name in ("rating_count", "item_min_range", "rating_distribution", "genre_popularity"):
        answer = con.execute(ORACLE[name])
        names = [column[0] for column in answer.description]
        want = _rows(names, answer.fetchall())
        got = QUERIES[name](spark, str(tmp_path))
        assert _rows(got.columns, got.collect()) == want and want
