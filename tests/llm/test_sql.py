"""Queries against their DuckDB statements, on whole small tables."""

import duckdb
import pytest

import __spark_entry__ as registry
from ratingloom.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    answer = con.execute(ORACLE_SQL[name])
    names = sorted(c[0] for c in answer.description)
    want = answer.df()[names]
    got = QUERIES[name](spark, sf_dir).select(*names).toPandas()
    keys = ("doc_id", "conv_id", "vec_id", "component", "part", "filter_order", "step")
    order = [c for c in keys if c in names]
    got, want = (df.sort_values(order).reset_index(drop=True) for df in (got, want))
    assert got.to_dict("list") == want.to_dict("list") and len(got)


def test_every_operator_is_registered():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{k}" for k in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(registry.queries())
