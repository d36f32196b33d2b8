import hashlib
import re
from itertools import permutations

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from ratingloom.llm import audit

from .conftest import ODD, docs_frame


def _fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        "A": len(words) < 200,
        "B": 100 * len(set(words)) < 50 * len(words),
        "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
        "D": any(c in text for c in "#$%&*|"),
    }


def _brute(rows, labels):
    """The report by applying every order to the documents one by one."""
    marked = []
    for doc_id, text, lang in rows:
        fails = _fails(text or "")
        fails["E"] = doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == (text or "") for i, t, _ in rows
        )
        marked.append((lang or "", fails, *labels.get(doc_id, (None, None))))
    out = {}
    for part in {m[0] for m in marked}:
        docs = [m for m in marked if m[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = docs
            for step, f in enumerate(order, 1):
                gone = [m for m in alive if m[1][f]]
                alive = [m for m in alive if not m[1][f]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive),
                    len(gone),
                    sum(m[1][f] for m in docs) - len(gone),
                    sum(m[1][f] and sum(m[1].values()) == 1 for m in docs),
                    sum(m[2] == 1 for m in gone),
                    sum(m[3] == 1 for m in gone),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(total[key[1][key[2] - 1]])
    return out


def _got(df):
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in df.collect()}


def _labels(spark, labels):
    rows = [(i, q, t, "clash", "clash") for i, (q, t) in labels.items()]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string, first string")


@given(st.lists(st.integers(0, 2**32 - 1), max_size=200))
def test_positional_popcount(values):
    words = np.array(values, np.uint32)
    want = [sum(v >> k & 1 for v in values) for k in range(32)]
    assert audit.positional_popcount(words).tolist() == want


def test_survival_words():
    for failed in range(32):
        alive = [s for s in range(32) if int(audit.WORDS[failed]) >> s & 1]
        assert alive == [s for s in range(32) if not s & failed]


def test_odd_rows(spark, odd):
    rich = " ".join(f"word{i}" for i in range(210))
    more = [
        (20, rich, "en", "a", 1), (21, rich, "en", "b", 1), (22, rich, "de", "b", 1),
        (23, rich + " #", "en", "b", 1), (24, rich.upper(), "", "b", 1), (25, rich.upper(), None, "b", 1),
        (26, "Ab " * 300, "en", "b", 1), (27, None, "en", "b", 1), (None, rich, "fr", "b", 1),
        (28, "é" * 97 + "ABC", "en", "b", 1), (29, "é" * 96 + "ABCD", "en", "b", 1),
    ]
    labels = {20: (1, 0), 21: (1, 1), 23: (0, 1), 5: (1, None), 12: (None, 1), 99: (1, 1), 26: (1, 1)}
    docs = odd.unionByName(docs_frame(spark, more))
    docs = docs.withColumns({c: docs["doc_id"] for c in ("part", "digest", "failed", "first", "quality")})
    rows = [r[:3] for r in ODD + more]
    want = _brute(rows, labels)
    assert _got(audit.audit(docs, _labels(spark, labels))) == want
    assert {k[0] for k in want} == {"", "en", "de", "fr"} and len(want) == 4 * 600


def test_empty_tables(spark, none, odd):
    assert audit.audit(none, _labels(spark, {})).count() == 0
    without = audit.audit(odd, _labels(spark, {})).collect()
    assert len(without) == 3 * 600 and not any(r.good_lost or r.toxic_lost for r in without)


def test_many_parts_and_one_hot_text(spark, monkeypatch):
    """Parts beyond what a task holds at a time, and a text that a third of all rows share."""
    monkeypatch.setattr(audit, "_PARTS", 3)
    rows = [
        (i, "same text" if i % 3 == 0 else f"text {i} $", hashlib.md5(str(i % 17).encode()).hexdigest()[:4])
        for i in range(300)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    labels = {i: (i % 2, i % 5 == 0) for i in range(0, 300, 2)}
    labels = {i: (q, int(t)) for i, (q, t) in labels.items()}
    assert _got(audit.audit(docs, _labels(spark, labels))) == _brute(rows, labels)
