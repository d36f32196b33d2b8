import math
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from ratingloom.llm import langid

from .conftest import by_id, docs_frame

PATH = public_tokenizers.path("piece_bpe_32k.model")


def _all_ways(pieces, p, word):
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for begin in range(end):
            total[end] += total[begin] * p.get(word[begin:end], 0.0)
    return math.log(total[-1])


def test_forward_sums_all_segmentations():
    vocab = langid.vocabulary(PATH)
    pieces = langid.Pieces(vocab)
    rng = np.random.default_rng(0)
    table = np.vstack((rng.random((len(vocab), 2)) / len(vocab), np.zeros(2)))
    words = [b"the", "größe".encode(), b"x", b"thenonndtion" * 9, b"!?"]
    # Pieces of all lengths count: words that are, or hold, the longest ones.
    long = sorted((w for w in vocab if w[:1] == b" "), key=len)[-40:]
    assert pieces.longest > 20 and len(long[0]) > 12
    words += [w[1:] for w in long] + [w[1:] + w[1:] + b"s" for w in long[:10]] + [long[-1][1:] * 6]
    got = langid.word_scores(pieces, table, words)
    for k in range(2):
        p = dict(zip(vocab, table[:, k]))
        for w, value in zip(words, got[:, k]):
            assert abs(_all_ways(pieces, p, b" " + w) - value) < 1e-6


def test_expected_counts_cover_every_byte():
    vocab = langid.vocabulary(PATH)
    pieces = langid.Pieces(vocab)
    flat = np.full((len(vocab) + 1, 1), 1 / len(vocab))
    flat[-1] = 0
    words = [b"the", b"a" * 100, "höhe".encode()]
    weights = np.array([[2.0, 0.0], [0.0, 1.0], [1.0, 1.0]])
    counts = langid.expected_counts(pieces, flat, words, weights)
    covered = np.array([len(v) for v in vocab]) @ counts
    want = np.array([len(w) + 1 for w in words]) @ weights
    assert np.allclose(covered, want)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = langid.identify(docs, PATH).join(docs.select("doc_id", "lang"), "doc_id")
    hits = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert hits.first()[0] > 0.97
    flags = got.filter(F.col("held_out") != (F.crc32(F.col("doc_id").cast("string")) % 4 == 2))
    assert flags.isEmpty()


def test_odd_rows(odd, none, spark):
    got = by_id(langid.identify(odd, PATH))
    assert sum(map(len, got.values())) == odd.count()
    for i in (1, 2, 3, 8):
        assert (got[i][0].lang_pred, got[i][0].score) == ("und", 0.0)
    assert all(r.lang_pred in ("en", "de") and 0.5 <= r.score <= 1 for i in (0, 7, 9) for r in got[i])
    assert not got[None][0].held_out
    assert langid.identify(none, PATH).isEmpty()
    untrained = langid.identify(docs_frame(spark, [(1, "some text", None, "a", 0)]), PATH)
    assert [(r.lang_pred, r.score) for r in untrained.collect()] == [("und", 0.0)]


def test_a_task_needs_little_memory_besides_its_texts():
    vocab = langid.vocabulary(PATH)
    pieces = langid.Pieces(vocab)
    table = np.vstack((np.full((len(vocab), 8), 1.0 / len(vocab)), np.zeros(8)))
    texts = pa.array([" ".join(f"w{i % 50}x{i % 7}" for i in range(k, k + 400)) for k in range(3000)])
    words = [b"thenonndtion%d" % i for i in range(5000)]
    scores = langid._Scores(pieces, table)
    tracemalloc.start()
    for _, _, data, offsets in langid.text_slices(texts, langid._SLICE):
        scores.of(langid.words_of(data, offsets))
    slices = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    langid.expected_counts(pieces, table[:, :1], words, np.ones((5000, 8)))
    counts = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert slices < 90e6 and counts < 45e6
