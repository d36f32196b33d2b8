import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import minhash, shared
from ratingloom.llm.graph import components

from .conftest import by_id, docs_frame
from .plain import groups, near_groups, shingles


def _family(rng, n, edits, length=60):
    """Near copies of one text, each with words replaced: many are close to the threshold."""
    base = [f"w{rng.randrange(500)}" for _ in range(length)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_components_equal_brute_force(spark, small_rows):
    rng = random.Random(1)
    texts = [r["text"] for r in small_rows]
    texts += _family(rng, 60, 4) + _family(rng, 30, 2) + [texts[0]] * 40
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    sets, want = near_groups(dict(enumerate(texts)))
    got = by_id(minhash.near_duplicates(docs_frame(spark, rows).repartition(5)))
    assert {i: r[0].component_id for i, r in got.items()} == want
    assert {i: r[0].n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert {i for i, r in got.items() if r[0].kept} == set(want.values())


def test_odd_rows(odd):
    got = by_id(minhash.near_duplicates(odd))
    assert sum(map(len, got.values())) == odd.count()
    alone = {i: (r[0].n_shingles, r[0].component_id, r[0].kept) for i, r in got.items()}
    assert alone[1] == (0, 1, True) and alone[2] == (0, 2, True) and alone[3] == (0, 3, True)
    assert [alone[i][1] for i in (4, 5, 6)] == [4, 4, 4]
    assert alone[10][1] == 0 and not alone[10][2]
    assert alone[None] == (2, None, True)
    kept = minhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == [-1, 0, 1, 2, 3, 4, 7, 8, 9, 12]


def test_empty(none):
    assert minhash.near_duplicates(none).isEmpty()


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(2)
    texts = _family(rng, 20, 8, 400)
    signed = minhash.signatures(docs_frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts)]))
    a = signed.select(F.col("doc_id").alias("i"), F.col("sig").alias("x"))
    b = signed.select(F.col("doc_id").alias("j"), F.col("sig").alias("y"))
    rows = a.join(b, F.col("i") < F.col("j")).select("i", "j", minhash.estimate("x", "y").alias("e"))
    errors = []
    for r in rows.collect():
        x, y = shingles(texts[r.i]), shingles(texts[r.j])
        errors.append(r.e - len(x & y) / len(x | y))
    assert abs(np.mean(errors)) < 0.05 and np.max(np.abs(errors)) < minhash.MARGIN


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(3)
    pairs = {
        "chain": [(i, i + 1) for i in range(70)],
        "star": [(50, i) for i in range(100) if i != 50] + [(50, 50), (None, 3)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "none": [],
    }[shape]
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    real = [(a, b) for a, b in pairs if a is not None and a != b]
    want = groups({x for p in real for x in p}, real)
    assert {r.node: r.component for r in got.collect()} == want


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_only_doubtful_rows_are_joined(spark, monkeypatch, bits):
    """Rows whose ids are surely not among those that go pass by; a full bit map changes nothing."""
    rng = random.Random(3)
    texts = _family(rng, 20, 2) + [" ".join(f"y{i} {i}" for i in range(k, k + 30)) for k in range(0, 3000, 30)]
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    rows += [(5, texts[-1], "en", "b", 0), (None, texts[-2], "en", "a", 0), (None, "", "en", "a", 0)]
    docs = docs_frame(spark, rows).repartition(3)
    asked, among = [], shared.may_be_among

    def may_be_among(wanted, *columns):
        asked.extend(r[0] for r in wanted.collect())
        return among(wanted, *columns)

    monkeypatch.setattr(shared, "FILTER_BITS", bits)
    monkeypatch.setattr(shared, "may_be_among", may_be_among)
    got = minhash.drop_near_duplicates(docs)
    kept = {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}
    found = [r.doc_id for r in got.collect()]
    assert sorted(i for i in found if i is not None) == sorted(kept - {None})
    assert found.count(None) == 1
    assert set(asked) == (set(range(len(texts))) - kept) | {5}
    assert 0 < len(asked) < len(texts) / 4 and len(kept) > 90


def test_bit_map_in_sql_never_turns_away_what_is_wanted(spark):
    ids = spark.range(0, 4000, 40)
    asked = shared.may_be_among(ids, F.xxhash64("id"), F.xxhash64("id"))
    passed = {r.id for r in spark.range(4000).filter(asked).collect()}
    assert set(range(0, 4000, 40)) <= passed and len(passed) < 150
