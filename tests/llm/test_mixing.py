from collections import defaultdict

import pytest

from ratingloom.llm import mixing

from .conftest import docs_frame
from .plain import words


def _targets(sizes, weights=(5, 2, 1)):
    """Share by weight, again and again, until no source is above three times its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while True:
        level = left / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
            free.discard(s)


def test_targets_and_takes(spark):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate(
        [("a", 4000), ("a", 9), ("b", 30), ("b", 1), ("c", 2500), (None, 700), (None, 3)]
    )]
    got = mixing.mix(docs_frame(spark, rows), block=64).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert r.taken <= 3 * r.size
    want = _targets(sizes)
    assert target == pytest.approx(want)
    assert want["b"] == 93
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_schedule_is_even_at_every_length(spark, small):
    sizes = mixing.sized(small)
    sources = mixing.targets(sizes)
    slots = mixing.schedule(sources, 64).orderBy("slot").collect()
    total = {r.source_no: r.target for r in sources.collect()}
    whole = sum(total.values())
    ranks = defaultdict(int)
    for n, slot in enumerate(slots, 1):
        assert slot.rank == ranks[slot.source_no]
        ranks[slot.source_no] += 1
        if n % 100 == 0:
            for s, t in total.items():
                assert abs(ranks[s] - n * t / whole) < 8


def test_odd_rows(odd):
    rows = mixing.mix(odd)
    assert rows.count() == odd.count()
    for r in rows.collect():
        assert r.taken == 0 if r.size == 0 else r.taken <= 3 * r.size
    sizes = {(r.doc_id, r.size) for r in rows.collect()}
    assert {(i, len(words(t))) for i, t, *_ in odd.select("doc_id", "text").collect()} == sizes
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    assert mixed.filter("text is null or trim(text) = ''").isEmpty()


def test_copies_follow_takes(small):
    takes = {r.doc_id: r.taken / r.size for r in mixing.mix(small).collect() if r.size}
    copies = {r.doc_id: r["count"] for r in mixing.mixed_documents(small).groupBy("doc_id").count().collect()}
    assert all(abs(copies.get(i, 0) - t) <= 0.5 for i, t in takes.items())


def test_empty(none):
    assert mixing.mix(none).isEmpty() and mixing.mixed_documents(none).isEmpty()
