import random
import re

import numpy as np
import pytest

from ratingloom.llm import substrings

from .conftest import ODD, docs_frame

WHITE = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(rows, window=35):
    texts = [WHITE.findall(t or "") for _, t, *_ in rows]
    places = {}
    for k, w in enumerate(texts):
        for p in range(len(w) - window + 1):
            places.setdefault(tuple(w[p : p + window]), []).append((k, p))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for k, p in found:
                gone[k].update(range(p, p + window))
    return sorted(
        (str(r[0]), len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g))
        for r, w, g in zip(rows, texts, gone)
    )


def _got(docs, **parameters):
    return sorted(
        (str(r.doc_id), r.n_words, r.n_removed, r.kept_text)
        for r in substrings.without_repeats(docs, **parameters).collect()
    )


def _passages(seed, n=120):
    """Texts of few words with passages shared in part, cut at random places, some overlapping."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ä", "ä", "x,"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(20, 90))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 30))]
            p = rng.choice(passages)
            low = rng.randint(0, len(p) - 1)
            words += p[low : rng.randint(low, len(p))]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words), "en", "a", 1))
    return rows


def _periodic():
    """Texts that repeat themselves, and a passage that a third of all rows share."""
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1000 + i, shared + f" tail{i} " + "end " * (i % 9), "en", "a", 1) for i in range(60)]
    rows += [(2000, "x " * 400, "en", "a", 1), (2001, "a b c " * 60, "en", "a", 1)]
    rows += [(2002, "y " * 35, "en", "a", 1), (2003, "y " * 34, "en", "a", 1), (2004, "z " * 36, "en", "a", 1)]
    return rows


@pytest.mark.parametrize("group", [1 << 16, 5, 0], ids=["grouped", "some crowded", "all crowded"])
def test_against_brute_force(spark, group):
    rows = _passages(1) + _periodic()
    docs = docs_frame(spark, rows).repartition(7)
    want = _brute(rows)
    assert _got(docs, group=group) == want
    assert 0 < sum(w[2] for w in want) < sum(w[1] for w in want)


@pytest.mark.parametrize("window, seed", [(5, 3), (7, 7), (12, 1), (35, 12)])
def test_other_windows(spark, window, seed):
    rows = _passages(window, 60)
    assert _got(docs_frame(spark, rows), window=window, seed=seed) == _brute(rows, window)


def test_odd_rows(spark, odd):
    clash = odd.withColumns({c: odd["doc_id"] for c in ("row", "at", "seed", "spans", "begin", "prefix")})
    assert _got(clash) == _brute(ODD)


def test_empty(spark, none):
    assert _got(none) == []


def test_anchors_follow_the_window():
    """Equal windows have equal anchors; each window has one, and they cover all windows."""
    rng = np.random.default_rng(0)
    values = rng.integers(0, 4, 500).astype(np.uint64)
    for width in (1, 2, 3, 7, 16, 24):
        best = substrings._first_smallest(values, width)
        for i, b in enumerate(best):
            assert b == i + int(np.argmin(values[i : i + width]))


def test_whole_small_table(spark, small, small_rows):
    rows = [(r["doc_id"], r["text"]) for r in small_rows]
    assert _got(small) == _brute(rows)
