import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ratingloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def _check(rows, pieces, length=4096):
    tokenizer = Tokenizer.from_file(PATH)
    want, got = defaultdict(list), defaultdict(list)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[doc_id].append(np.array([*ids, 2], "<u4"))
    sequences = defaultdict(list)
    for p in pieces:
        got[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    assert set(got) == set(want)
    for doc_id, ids in want.items():
        copies = len(ids)
        assert sum(p.length for p in got[doc_id]) == sum(map(len, ids))
        if copies == 1:
            at = 0
            for p in sorted(got[doc_id], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(ids[0])
                at += p.length
                assert p.ids_crc32 == zlib.crc32(ids[0][p.start : at].tobytes())
    for parts in sequences.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or (at < length and at & (at - 1) == 0)


def test_exact_round_trip(small, small_rows):
    pieces = packing.pack(small, PATH).collect()
    _check([(r["doc_id"], r["text"]) for r in small_rows], pieces)


def test_odd_rows_and_empty(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    _check(rows, packing.pack(odd, PATH, length=256).collect(), 256)
    assert packing.pack(none, PATH).isEmpty()


def test_added_tokens_are_those_of_the_plain_call(spark):
    texts = [
        "ab <|endoftext|> cd", "ab<|endoftext|>cd", "<|ENDOFTEXT|> x", "<|startoftext|><|endoftext|>",
        "<|StartofText|>", "one two", "<|endoftext|", "Ünï <|endoftext|> Ü",
    ]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    _check(rows, packing.pack(docs, PATH, length=8).collect(), 8)


def test_words_kept_and_forgotten(small_rows, monkeypatch):
    monkeypatch.setattr(packing, "_KEPT", 500)
    tokens = packing.WordTokens(PATH)
    texts = [(r["text"] or "").encode() for r in small_rows[:60]]
    want = packing.Tokenizer.from_file(PATH)
    for low in range(0, 60, 5):
        for text, ids in zip(texts[low : low + 5], tokens.encode(texts[low : low + 5])):
            assert ids == np.array(want.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()
    assert tokens.older


def test_one_place_is_split_by_id(spark):
    """Texts of one place, a third of all, are dealt to several tasks."""
    rows = [(i, "same words here" if i % 3 == 0 else f"word{i} other{i * 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = packing.along_curve(docs)
    of = placed.select("doc_id", "text", packing.F.spark_partition_id().alias("part")).collect()
    assert len({r.part for r in of if r.doc_id % 3 == 0}) > 1
    sizes = [sum(r.part == k for r in of) for k in {r.part for r in of}]
    assert sum(sizes) == 3000 and max(sizes) < 1000
    _check(rows, packing.pack(docs, PATH).collect())


def test_hilbert_neighbours_are_adjacent():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = packing.hilbert_index(grid, 3)
    assert sorted(index) == list(range(512))
    walk = grid[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_words_of_many_bytes_or_ids_and_zeros(monkeypatch):
    """Words that differ only where a kept word is cut or filled up have their own ids."""
    monkeypatch.setattr(packing, "_KEPT", 4)
    tokens, want = packing.WordTokens(PATH), packing.Tokenizer.from_file(PATH)
    words = ["ab", "ab\0", "ab\0\0", "x" * 24, "x" * 25, "x" * 40, "é" * 12, "é" * 13, "中文" * 9, "qzj" * 8]
    texts = [" ".join(words), *words, " ".join(words[::-1]), ""]
    for _ in range(3):
        for text, ids in zip(texts, tokens.encode([t.encode() for t in texts])):
            plain = want.encode(text, add_special_tokens=False).ids
            assert ids == np.array(plain, "<u4").tobytes()


def test_many_words_are_kept():
    """Of 350,000 words, met in turn, few are encoded again the next time."""
    tokens = packing.WordTokens(PATH)
    encoded = 0
    plain = tokens.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **given):
            nonlocal encoded
            encoded += sum(len(t.split()) for t in texts)
            return plain.encode_batch_fast(texts, **given)

    tokens.tokenizer = Counting()
    letters = np.array(list("etaoinshrdlu"))
    digits = (np.arange(350_000)[:, None] // 12 ** np.arange(6)) % 12
    words = ["".join(w) for w in letters[digits]]
    texts = [" ".join(words[k : k + 10_000]).encode() for k in range(0, len(words), 10_000)]
    first = [tokens.encode([text]) for text in texts]
    assert encoded == len(words)
    assert [tokens.encode([text]) for text in texts] == first
    assert encoded < 1.3 * len(words)
