"""Physical plans, skewed joins and the checkpoint folder."""

import inspect
import random
import re
from collections import Counter
from types import SimpleNamespace

import pytest

import __spark_entry__ as registry
from ratingloom.operators import models
from ratingloom.plans import hot_keys, session
from ratingloom.plans.hot_keys import KeyStats, attach
from ratingloom.sources import warehouse

QUERIES = registry.queries()
FITTED = {"als_scored", "rf_check", "linreg_coefficients", "model_coverage"}
LAZY = sorted(set(registry.oracle_sql()) - registry.OPTIONAL_QUERIES - FITTED)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    plan = _plan(QUERIES[name](spark, sf_dir))
    for slow in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in plan


@pytest.mark.parametrize("name", ["item_min_range", "rating_range_histogram", "yearly_ratings"])
def test_ratings_are_scanned_once(name, spark, sf_dir):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert plan.count("lineitem.parquet") == plan.count("orders.parquet") == 1


def test_rank_limit_reaches_the_window(spark, sf_dir):
    assert "WindowGroupLimit" in _plan(QUERIES["top_genres_per_decade"](spark, sf_dir))


@pytest.mark.parametrize(
    "name", ["top_rated", "genre_combo_rating_range", "item_min_range", "top_tags", "tag_relevance"]
)
def test_top_k_is_not_a_full_sort(name, spark, sf_dir):
    assert "TakeOrderedAndProject" in _plan(QUERIES[name](spark, sf_dir))


def test_scans_read_only_what_is_used(spark, sf_dir):
    plan = _plan(QUERIES["item_min_range"](spark, sf_dir))
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    assert schemas == {"l_orderkey:bigint,l_partkey:bigint,l_quantity:double", "o_orderkey:bigint"}
    assert "IsNotNull(l_partkey)" in plan


def test_ratings_shrink_before_the_first_shuffle(spark, sf_dir):
    for name in ("rating_distribution", "genre_popularity", "cumulative_trend", "top_rated"):
        plan = _plan(QUERIES[name](spark, sf_dir))
        lines = [line for line in plan.splitlines() if line.strip(" :+-")]
        scan = next(i for i, line in enumerate(lines) if "lineitem" in line)
        above = [i for i, line in enumerate(lines[:scan]) if "Exchange" in line][-1]
        assert any("HashAggregate" in line and "partial_" in line for line in lines[above:scan])


def test_features_name_the_ratings_once_for_both_keys(spark, sf_dir):
    """One pass over the ratings, and four over those behind the statistics of two keys."""
    plan = _plan(QUERIES["rating_features"](spark, sf_dir)).split("Initial Plan")[-1]
    assert plan.count("FileScan") and plan.count("lineitem.parquet") < 10


def _pairs(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    keys = [1] * 400 + [None] * 100 + [rng.randrange(2, 60) for _ in range(500)]
    facts = spark.createDataFrame([(k, 7) for k in keys], "k int, v int").repartition(6)
    stats = facts.groupBy("k").agg({"*": "count"}).toDF("k", "n").withColumn("x", registry.F.col("k") * 2)
    return facts, stats


@pytest.mark.parametrize("bound", [3, 10_000])
@pytest.mark.parametrize("hot_rows", [0, 5, 100, 10_000])
def test_attach_equals_a_left_join(skewed, hot_rows, bound, monkeypatch):
    """Whatever is hot and however many may be broadcast, with NULL keys on both sides."""
    monkeypatch.setattr(hot_keys, "HOT_KEYS", bound)
    facts, stats = skewed
    want = _pairs(facts.join(stats, "k", "left").select("k", "v", "x"))
    assert _pairs(attach(facts, [KeyStats("k", stats, "n")], hot_rows)) == want
    sizes = facts.groupBy("k").count().toDF("k", "n")
    fewer = stats.filter("k % 2 = 1 or k is null").drop("n")
    want = _pairs(facts.join(fewer, "k", "left").select("k", "v", "x"))
    assert _pairs(attach(facts, [KeyStats("k", fewer, "n", sizes)], hot_rows)) == want


@pytest.fixture
def third_on_one_key(spark, tmp_path):
    """30,000 rows in 8 files, a third on one key, with statistics kept from broadcasting."""
    path = str(tmp_path / "facts")
    spark.range(30_000).selectExpr(
        "if(id % 3 = 0, -1, id) as k", "md5(cast(id as string)) as v"
    ).repartition(8).write.parquet(path)
    facts = spark.read.parquet(path)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.openCostInBytes": "1m",
        "spark.sql.files.maxPartitionBytes": "1m",
    }
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    stats = facts.groupBy("k").agg(registry.F.count("*").alias("n"), registry.F.max("v").alias("x"))
    yield facts, stats
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _final(df):
    return _plan(df).split("Initial Plan")[0]


def test_rows_of_a_hot_key_are_spread(third_on_one_key):
    facts, stats = third_on_one_key
    got = attach(facts, [KeyStats("k", stats, "n")], 1_000)
    assert _pairs(got) == _pairs(facts.join(stats.drop("n"), "k", "left"))
    assert "skew=true" not in _final(got)
    sizes = got.groupBy(registry.F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 10_000


def test_uneven_partitions_are_split_at_run_time(third_on_one_key):
    facts, stats = third_on_one_key
    got = attach(facts, [KeyStats("k", stats, "n")], 10**9)
    assert _pairs(got) == _pairs(facts.join(stats.drop("n"), "k", "left"))
    assert "SortMergeJoin(skew=true)" in _final(got)


def test_adapted_join_sides_are_bare_scans(spark, sf_dir):
    """Nothing but a scan below each exchange, so adaptive execution can split a skewed order key."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(warehouse.ratings(spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Aggregate" not in plan


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


@pytest.mark.parametrize(
    ("shared", "master", "already", "want"),
    [
        ("hdfs://shared/ckpt", "yarn", None, "hdfs://shared/ckpt"),
        ("hdfs://shared/ckpt", "local[2]", None, "hdfs://shared/ckpt"),
        (None, "yarn", "hdfs://chosen", "hdfs://chosen"),
        (None, "yarn", None, None),
        (None, "local[2]", None, None),
    ],
)
def test_checkpoint_folder_comes_from_the_session(shared, master, already, want):
    """A cluster without a shared folder gets none, never a machine-local one."""
    context = _Context(master, already)
    conf = SimpleNamespace(get=lambda key, default: shared or default)
    spark = SimpleNamespace(conf=conf, sparkContext=context)
    assert session.use_checkpoint_dir(spark) == want == context.folder


@pytest.mark.parametrize("parallelism", [2, 64])
def test_fits_do_not_look_at_the_cluster(parallelism, monkeypatch):
    """No number of cores enters a fit."""
    als = models._als(10, 5, 0.1, 1, models.BLOCKS, "u", "i", "r")
    assert als.getNumUserBlocks() == als.getNumItemBlocks() == models.BLOCKS
    assert "defaultParallelism" not in inspect.getsource(models)


def test_entry_runs(spark):
    rows = registry.entry(spark).collect()
    assert 0 < len(rows) <= 5
