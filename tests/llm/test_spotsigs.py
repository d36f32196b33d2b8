import hashlib
import re
from itertools import combinations

from pyspark.sql import functions as F

from ratingloom.llm import spotsigs

from .conftest import docs_frame


def _signatures(text):
    """Anchors before content words, with two content words each."""
    common = set(spotsigs.COMMON)
    words = re.split(r"[^\w]|_", text.lower())
    words = [w for k, w in enumerate(words) if w or k in (0, len(words) - 1)]
    content = [i for i, w in enumerate(words) if w and w not in common]
    out = set()
    for k, i in enumerate(content):
        if i and words[i - 1] in common:
            after = words[content[k + 1]] if k + 1 < len(content) else None
            out.add((words[i - 1], words[i], after))
    return out or {text.lower()}


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def test_fingerprints_against_a_plain_version(spark, small, small_rows):
    rows = sorted(small_rows, key=lambda r: r["doc_id"])
    got = {r.doc_id: r for r in spotsigs.fingerprints(small).collect()}
    texts = [r["text"] for r in rows]
    for k, r in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[r["doc_id"]]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own = _signatures(text)
        assert len(row.fingerprint.split(" ")) == len(own)
        assert abs(row.near_edited - _jaccard(own, _signatures(edited))) < 1e-9
        assert abs(row.near_next - _jaccard(own, _signatures(after))) < 1e-9
    same = {}
    for r in rows:
        assert same.setdefault(r["text"], got[r["doc_id"]].fingerprint) == got[r["doc_id"]].fingerprint


def test_no_python_in_the_plan(small):
    plan = spotsigs.fingerprints(small)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_pairs_equal_brute_force(spark):
    rows = []
    for g in range(6):
        base = [f"the word{g}{k} of thing{g}{k}" for k in range(12 + g)]
        for c in range(6):
            rows.append((g * 10 + c, " ".join(base[: len(base) - c % 4] + [f"a new{c}{g}"] * (c % 2)), "", "", 0))
    frame = spotsigs.with_signatures(docs_frame(spark, rows), "text", "signatures")
    sets = frame.select(F.col("doc_id").alias("node"), "signatures")
    own = {r.node: set(r.signatures) for r in sets.collect()}
    want = {(a, b) for a, b in combinations(sorted(own), 2) if _jaccard(own[a], own[b]) >= 0.75}
    got = {tuple(sorted((r.a, r.b))) for r in spotsigs.similar_pairs(sets).collect()}
    assert got == want and len(want) > 10


def test_odd_rows_and_empty(odd, none, spark):
    got = spotsigs.fingerprints(odd).collect()
    assert len(got) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert {r.n_chars for r in got if r.doc_id in (1, 2)} == {0}
    assert spotsigs.fingerprints(none).isEmpty()
    (one,) = spotsigs.fingerprints(docs_frame(spark, [(1, "abcd", "", "", 0)])).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1
