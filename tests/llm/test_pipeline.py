"""Stages of the pipeline on their own inputs."""

import corpus_pipeline as pipeline
import public_tokenizers
from ratingloom.llm import line_dedup, mixing, shared

from .conftest import SMALL
from .plain import near_groups


def test_stages_are_whole(spark, small):
    docs, columns = small, small.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        out = shared.stored(stage(spark, docs, SMALL), f"test-{name}")
        if name != "packing":
            assert out.columns == columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
        seen[name] = (docs, out)
        docs = out
    assert [n for n, _ in pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "mixing", "packing"]

    before, after = seen["language"]
    assert before.exceptAll(after).filter("text rlike '[a-z]'").isEmpty()
    before, after = seen["line_dedup"]
    want = {(r.doc_id, r.kept_text) for r in line_dedup.dedup_lines(before).collect()}
    assert {(r.doc_id, r.text) for r in after.collect()} == want
    before, after = seen["near_dedup"]
    _, groups = near_groups({r.doc_id: r.text for r in before.collect()})
    assert sorted(r.doc_id for r in after.collect()) == sorted(set(groups.values()))
    before, after = seen["mixing"]
    takes = {r.doc_id: int(r.taken / r.size + 0.5) for r in mixing.mix(before).collect() if r.size}
    assert sum(takes.values()) == after.count()
    before, after = seen["packing"]
    assert after.selectExpr("sum(length)").first()[0] == after.groupBy("doc_id", "start", "sequence_id", "offset").max("length").selectExpr("sum(`max(length)`)").first()[0]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}


def test_empty_and_odd(spark, odd, none):
    for frame in (none, odd):
        docs = frame
        for name, stage in pipeline.STAGES:
            docs = shared.stored(stage(spark, docs, ""), f"odd-{name}")
        assert docs.isEmpty() == (frame is none)
    assert public_tokenizers.path("word_bpe_49k.json")


def test_columns_of_any_name_pass_through(spark, odd):
    """Whatever a stage names its own columns, those of the documents come out as they went in."""
    added = [c for c in odd.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
    assert len(added) >= 30
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, odd, "")
        assert out.columns == odd.columns and out.dtypes == odd.dtypes
        assert all(r[c] == "clash" for r in out.collect() for c in added), name


def _near(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(3)
    kept = pipeline.drop_near_duplicates(spark, docs, "").collect()
    return sorted(((r.doc_id, r.text, r.n) for r in kept), key=str)


def test_rows_without_id_are_judged_one_by_one(spark):
    one, two = "the first of all texts here is this", "another text that nobody else has got"
    rows = [(1, one, 0), (None, one, 1), (None, two, 2), (None, two, 3), (None, None, 4), (2, "", 5)]
    want = [(1, one, 0), (None, two, 2), (None, two, 3), (None, None, 4), (2, "", 5)]
    assert _near(spark, rows) == sorted(want, key=str)


def test_of_repeated_ids_the_smallest_text_stays(spark):
    a, b = "a text of some words that come first", "b text of quite other words that come later"
    rows = [(1, b, 0), (1, a, 1), (1, None, 2), (2, b + " and end", 3), (3, a, 4), (4, "x", 5), (4, "x", 5)]
    want = [(1, a, 1), (2, b + " and end", 3), (4, "x", 5)]
    for _ in range(2):
        got = _near(spark, rows)
        assert [r for r in got if r[0] != 2] == [r for r in want if r[0] != 2]
