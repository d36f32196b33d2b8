import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ratingloom.llm import lm

from .conftest import by_id
from .plain import words

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _base(rows):
    """Add-one unigram scores, counted plainly."""
    held = {i for i, _ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter()
    for i, text in rows:
        if i not in held:
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        tokens = [*words(text), None]
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out[i] = (i in held, len(tokens), sum(t in counts for t in tokens), n, score)
    return out


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs, lm.score_texts(docs, PATH).collect()


def test_base_equals_brute_force(scored):
    docs, got = scored
    want = _base([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len(got) == len(want)
    for r in got:
        held, n, known, total, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9)


def test_model_learns(scored):
    rows = [r for r in scored[1] if r.n_tokens > 50]
    assert all(math.isfinite(r.score) and r.score < 0 for r in scored[1])
    known = [r for r in rows if r.n_known == r.n_tokens]
    assert np.mean([r.score > r.base_score for r in known]) > 0.9


def test_gradients():
    classes = np.arange(50) % 7
    net = lm.Attention(classes, 50)
    for name in net.NAMES:
        setattr(net, name, getattr(net, name).astype(np.float64))
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 50, (3, 9))

    def loss():
        own, _ = net.log_scores(ids[:, :-1], ids[:, 1:], np.ones(7), 0)
        return -own.mean()

    grads, touched = net._gradients(ids[:, :-1], classes[ids[:, 1:]])
    rows, grads["embed"] = grads["embed"], np.zeros_like(net.embed)
    grads["embed"][touched] = rows
    for name in net.NAMES:
        value = getattr(net, name)
        at = (int(ids[0, 0]), 3) if name == "embed" else (2,) * value.ndim
        at = tuple(min(a, s - 1) for a, s in zip(at, value.shape))
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        down = loss()
        value[at] += 1e-5
        assert grads[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_windows_score_each_position_once():
    """In windows and with each position's own window alone."""
    sub = lm.subwords(PATH)
    rng = np.random.default_rng(1)
    classes = np.where(sub.starts, 1, lm.START_CLASSES + 1)
    classes[sub.end] = 0
    classes += rng.integers(0, 3, sub.size) * (classes > 0)
    net = lm.Attention(classes, sub.size)
    lengths = np.array([1, 32, 33, 100, 57])
    ids = rng.integers(3, 500, lengths.sum())
    starting = np.zeros(int(classes.max()) + 1, np.float32)
    starting[: lm.START_CLASSES + 1] = 1
    got, _ = lm._id_scores((net, starting), sub, ids, lengths)
    step = lm.LENGTH - lm.OVERLAP
    for first, n in zip(np.cumsum(lengths) - lengths, lengths):
        inputs = np.concatenate(([sub.begin], ids[first : first + n - 1]))
        for k in range(n):
            window = 0 if k < lm.LENGTH else ((k - lm.LENGTH) // step + 1) * step
            part = inputs[None, window : k + 1]
            own, _ = net.log_scores(part, ids[None, first + window : first + k + 1], starting, 0)
            assert got[first + k] == pytest.approx(own[-1], abs=1e-4)


def test_odd_rows_and_empty(odd, none):
    got = by_id(lm.score_texts(odd, PATH))
    want = _base([(r.doc_id, r.text) for r in odd.collect()])
    assert sum(map(len, got.values())) == odd.count()
    for i, rows in got.items():
        assert [(r.n_tokens, r.n_known) for r in rows] == [want[i][1:3]] * len(rows)
        assert rows[0].base_score == pytest.approx(want[i][4], rel=1e-9)
    assert got[1][0].n_tokens == 1 and math.isfinite(got[1][0].score)
    assert lm.score_texts(none, PATH).isEmpty()


def test_windows_predict_every_id_once():
    rng = np.random.default_rng(3)
    lengths = np.array([2, 33, 34, 100, 65, 3])
    sequence = np.arange(lengths.sum())
    got = lm._windows(sequence, lengths)
    first = set((np.cumsum(lengths) - lengths).tolist())
    pairs = {(a, b) for w in got.tolist() for a, b in zip(w, w[1:])}
    assert {(i - 1, i) for i in sequence.tolist() if i not in first} <= pairs
    tiny = lm._windows(np.array([1, 2]), np.array([2]))
    assert tiny.shape == (1, lm.LENGTH + 1)


def test_all_text_is_learnt_from(spark, monkeypatch):
    """Every window is learnt from, none of a held-out text; classes know all frequent ids."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(lm, "_SLICE", 2000)
    monkeypatch.setattr(lm, "_TOKENS", 300)
    monkeypatch.setattr(lm, "STEPS", 2)
    sub = lm.subwords(PATH)
    texts = ["a house of copies " * 60] * 40 + [f"the river number {i} is long" for i in range(300)]
    texts.append("ends in a space that the vocabulary drops \u200b \ufeff")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    encoded = lm._encoded(docs.withColumn("held_out", lm.held_out(docs.doc_id)), PATH)
    assert encoded.count() > 6
    counts = np.zeros(sub.size)
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    for text, out in zip(texts, held):
        for word in [] if out else words(text):
            ids = sub.model.encode(word.decode() if isinstance(word, bytes) else word)
            np.add.at(counts, ids or [sub.blank], 1)
    got = lm._id_counts(encoded, sub)
    assert np.array_equal(got, counts)

    learnt = []
    learn = lm._learn

    def watched(encoded, path, net):
        before = net.rows()
        learnt.append(learn(encoded, path, net))
        assert (net.rows() != before).any()

    monkeypatch.setattr(lm, "_learn", watched)
    counts[sub.end] = held.count(False)
    net = lm._fitted(encoded, PATH, counts, sub, 20)
    least = int(counts.sum()) // lm.LENGTH
    # Each run of documents has at most one window that is not full of new ids.
    runs = sum(len(list(lm.Chunk(t, 0).parts())) for t in _one_by_one(encoded))
    assert len(learnt) == 1 and least <= learnt[0] <= least + 2 * runs
    often = np.flatnonzero((counts >= 5) & sub.starts)
    assert (net.classes[often] != lm.START_CLASSES).all()


def _one_by_one(encoded):
    table = encoded.toArrow().combine_chunks()
    return [table.slice(k, 1) for k in range(table.num_rows)]


def test_chunks_hold_all_words(spark, odd):
    """Words, ids and documents read back from the chunks are those of the texts."""
    rows = odd.withColumn("held_out", lm.held_out(F.col("doc_id")))
    sub = lm.subwords(PATH)
    got = Counter()
    for table in _one_by_one(lm._encoded(rows, PATH)):
        chunk = lm.Chunk(table, 0)
        ids = table["doc_id"][0].as_py()
        for low, high, tokens in chunk.parts():
            ends = np.cumsum(chunk.n_words[low:high])
            for doc, own in zip(ids[low:high], np.split(tokens, ends[:-1])):
                pieces = chunk.ids[lm._spread(chunk.starts[own], chunk.each[own])]
                got[doc, tuple(pieces.tolist())] += 1
    want = Counter()
    for r in odd.collect():
        cut = [w.decode() if isinstance(w, bytes) else w for w in words(r.text)]
        want[r.doc_id, tuple(i for w in cut for i in sub.model.encode(w) or [sub.blank])] += 1
    assert got == want


def test_kept_ids_are_those_of_the_words():
    """Words met before, of full slots and of many ids, and only new ones are cut."""
    sub = lm.subwords(PATH)
    asked = []

    class Watched(lm.Subwords):
        def of(self, data, starts, ends):
            asked.append(len(starts))
            return super().of(data, starts, ends)

    kept = lm.KeptIds(Watched(PATH), 64)
    parts = ["the", "river", "x" * 90, "\u200b", "é", "copies"] + [f"w{i}" for i in range(100)]
    for rows in (parts[:60], parts[30:], parts, parts[:0], parts[::-1]):
        data = [w.encode() for w in rows]
        ends = np.cumsum([0, *map(len, data)])
        hashes = np.array([lm.mix(np.array([parts.index(w) + 1], np.uint64))[0] for w in rows], np.uint64)
        ids, each = kept.of(hashes, b"".join(data), ends[:-1], ends[1:])
        want = [sub.model.encode(w) or [sub.blank] for w in rows]
        assert ids.tolist() == [i for one in want for i in one]
        assert each.tolist() == [len(one) for one in want]
    assert asked[0] == 60 and asked[2] <= len(parts) - 32 and asked[3] == 0 and asked[4] == asked[2]


def test_words_of_one_chunk_stay_in_it(spark, monkeypatch):
    """Only words that several chunks have travel back; counts are those of all chunks."""
    monkeypatch.setattr(lm, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(lm, "_SLICE", 1000)
    monkeypatch.setattr(lm, "STEPS", 2)
    texts = [f"the river of n{i} is as long as m{i} or n{i}" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    returned = []
    score = lm._score

    def watched(path, model, n_docs):
        inner = score(path, model, n_docs)

        def scored(chunks, words):
            out = inner(chunks, words)
            # More rows that come back than words that all chunks share would be one for each.
            assert words.num_rows < len(chunks["n"][0]) / 2
            return out

        returned.append(True)
        return scored

    monkeypatch.setattr(lm, "_score", watched)
    got = by_id(lm.score_texts(docs, PATH))
    want = _base(list(enumerate(texts)))
    assert returned
    for i, rows in got.items():
        r = rows[0]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[i][1:4]
        assert r.base_score == pytest.approx(want[i][4], rel=1e-9)


def test_texts_come_in_small_batches(spark, odd, monkeypatch):
    """An executor holds batches of some MB, not of 64, for each task on both sides."""
    limit = lm.shared._BATCH_LIMIT
    spark.conf.unset(limit)
    lm.score_texts(odd, PATH)
    assert int(spark.conf.get(limit)) <= 4 << 20
