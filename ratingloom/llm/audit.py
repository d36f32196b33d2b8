"""How quality filters interact, whatever the order in which they are applied.

Five filters have 32 subsets. A document becomes a word of 32 bits, its truth table: bit S is set
if the document survives the filters of subset S. How many documents survive each subset is then
the positional popcount of the words, by part and label, and every order's report follows from
those 32 counts: removing by filter f after the filters S takes survivors(S) - survivors(S + f).

Positional popcounts are made by carry-save adders: three words of one weight become a word of
that weight (their parity) and one of twice the weight (their majority), until one word is left of
each weight. All 32 positions are added up at once.

Texts are read where they lie. Only ids, digests and marks are shuffled: once by digest, to find
copies of a text, and once by id, to meet the labels. A digest of very many copies is split by
adaptive execution, as its side of the join needs no key together.
"""

import math
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.words import text_slices, words_of

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
#: The characters that filter D looks for.
SYMBOLS = "#$%&*|"
#: A task hands on what it has counted after so many parts.
_PARTS = 4096

_SUBSETS = 1 << len(FILTERS)
_CLASSES = ("all", "good", "toxic")
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[[ord(c) for c in SYMBOLS]] = True
#: The survival word of each set of failed filters.
WORDS = np.array(
    [sum(1 << s for s in range(_SUBSETS) if not failed & s) for failed in range(_SUBSETS)],
    np.uint32,
)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """For each of the 32 bit positions, the number of words that have it set."""
    counts = np.zeros(32, np.int64)
    positions = np.arange(32, dtype=np.uint32)
    weight, level = 1, words
    while len(level):
        carries = []
        while len(level) > 1:
            n = len(level) // 3
            if n:
                a, b, c = level[: 3 * n].reshape(3, n)
                half = a ^ b
                carries.append((a & b) | (half & c))
                level = np.concatenate((half ^ c, level[3 * n :]))
            else:
                a, b = level
                carries.append((a & b)[None])
                level = (a ^ b)[None]
        counts += weight * ((level[0] >> positions) & np.uint32(1)).astype(np.int64)
        level = np.concatenate(carries) if carries else level[:0]
        weight *= 2
    return counts


def _failed(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of the filters A to D that each text fails."""
    found = words_of(data, offsets, lower=False)
    n_words = found.per_doc()
    order = np.lexsort((found.hashes, found.doc))
    h, doc = found.hashes[order], found.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    distinct = np.bincount(doc[new], minlength=found.n_docs)

    def per_text(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mark)))
        return total[offsets[1:]] - total[offsets[:-1]]

    upper = per_text((data >= 65) & (data <= 90))
    chars = per_text((data & 0xC0) != 0x80)
    fails = (
        n_words < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * n_words,
        100 * upper > MAX_UPPER_PERCENT * chars,
        per_text(_IS_SYMBOL[data]) > 0,
    )
    return sum(mark.astype(np.int32) << k for k, mark in enumerate(fails))


def failures(docs: DataFrame) -> DataFrame:
    """``doc_id, part, failed`` for every row: the filters that it fails, A in the lowest bit.

    A text is a copy (E) if a smaller doc_id has the same text; rows of one doc_id do not make
    copies of each other, and a row without doc_id neither is a copy nor makes any.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(3)):
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k)[low:high] for k in range(3)),
                        pa.array(_failed(data, offsets), pa.int32()),
                    ],
                    ["doc_id", "part", "digest", "failed"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    judged = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.md5(text)).alias("digest"),
        text.alias("text"),
    ).mapInArrow(judge, "doc_id long, part string, digest binary, failed int")
    judged = shared.stored(judged, "judged")
    first = (
        judged.groupBy("digest")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("last > first")
        .select("digest", "first")
    )
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    bit = 1 << FILTERS.index("E")
    # Stored, so that the join shuffles both sides and adaptive execution can split a hot digest.
    first = shared.stored(first, "first")
    return judged.join(first, "digest", "left").select(
        "doc_id", "part", F.col("failed").bitwiseOR(F.when(copy, bit).otherwise(0)).alias("failed")
    )


def survivors(marked: DataFrame) -> DataFrame:
    """``part, class, s0 .. s31``: how many documents of a part survive each subset of filters.

    ``marked`` has part, failed, quality and toxic. Classes are all documents, and those with
    quality 1 and with toxic 1.
    """
    names = [f"s{s}" for s in range(_SUBSETS)]

    def rows(counts: dict[str, np.ndarray]) -> pa.RecordBatch:
        of = [(part, k) for part in counts for k in range(len(_CLASSES))]
        table = np.array([counts[part][k] for part, k in of]).reshape(-1, _SUBSETS)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part for part, _ in of], pa.string()),
                pa.array([_CLASSES[k] for _, k in of], pa.string()),
                *(pa.array(column, pa.int64()) for column in table.T),
            ],
            ["part", "class", *names],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            code = coded.indices.to_numpy()
            order = np.argsort(code, kind="stable")
            words = WORDS[batch.column(1).to_numpy()[order]]
            label = [
                batch.column(k).fill_null(0).to_numpy(zero_copy_only=False)[order] == 1
                for k in (2, 3)
            ]
            ends = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
            for part, low, high in zip(coded.dictionary.to_pylist(), ends, ends[1:]):
                own = words[low:high]
                per_class = [own, *(own[mark[low:high]] for mark in label)]
                found = np.array([positional_popcount(w) for w in per_class])
                counts[part] = counts[part] + found if part in counts else found
            if len(counts) > _PARTS:
                yield rows(counts)
                counts = {}
        if counts:
            yield rows(counts)

    schema = "part string, class string, " + ", ".join(f"{n} long" for n in names)
    return (
        marked.select("part", "failed", "quality", "toxic")
        .mapInArrow(count, schema)
        .groupBy("part", "class")
        .agg(*[F.sum(n).alias(n) for n in names])
    )


def _steps() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Order, filter, and subsets before and after, of every step of every order."""
    orders, of, before = [], [], []
    for order in permutations(range(len(FILTERS))):
        done = 0
        for f in order:
            orders.append("".join(FILTERS[k] for k in order))
            of.append(f)
            before.append(done)
            done |= 1 << f
    bits = 1 << np.array(of)
    return orders, np.array(of), np.array(before), np.array(before) | bits


_REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def report(counts: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step, from the counts of ``survivors``."""
    names = [f"s{s}" for s in range(_SUBSETS)]
    per_part = counts.groupBy("part").agg(
        *[
            F.max(F.when(F.col("class") == c, F.array(*names))).alias(c)
            for c in _CLASSES
        ]
    )

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders, of, before, after = _steps()
        n, last = len(FILTERS), _SUBSETS - 1
        bit = 1 << of
        for batch in batches:
            for row in batch.to_pylist():
                alive, good, toxic = (np.array(row[c], np.int64) for c in _CLASSES)
                removed = alive[before] - alive[after]
                shapley = np.zeros(n, np.int64)
                for f in range(n):
                    for s in range(_SUBSETS):
                        if not s >> f & 1:
                            k = s.bit_count()
                            weight = math.factorial(k) * math.factorial(n - 1 - k)
                            shapley[f] += weight * (alive[s] - alive[s | 1 << f])
                columns = [
                    alive[after],
                    removed,
                    alive[0] - alive[bit] - removed,
                    alive[last ^ bit] - alive[last],
                    good[before] - good[after],
                    toxic[before] - toxic[after],
                    shapley[of],
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(of)),
                        pa.array(orders),
                        pa.array(np.arange(len(of)) % n + 1, pa.int32()),
                        *map(pa.array, columns),
                    ],
                    [c.split()[0] for c in _REPORT.split(", ")],
                )

    return per_part.mapInArrow(tell, _REPORT)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter takes at each step of each of the 120 orders, for each part of ``docs``.

    ``docs`` has doc_id, text and lang, which names the part (null: the empty string); ``labels``
    has doc_id, quality and toxic, of repeated labels the largest holds. A null text is empty: it
    has too few words (A) and fails no other filter but E. Every row counts, repeated ones too; a
    row without doc_id has no label. Without documents there are no rows. Other columns are not
    looked at.
    """
    shared.ship(docs.sparkSession)
    marks = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(*[F.max(F.col(c).cast("int")).alias(c) for c in ("quality", "toxic")])
    )
    marks = shared.stored(marks, "marks")
    return report(survivors(failures(docs).join(marks, "doc_id", "left")))
