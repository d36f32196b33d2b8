"""Removal of word sequences that occur elsewhere, by prefix-partitioned suffix trees.

Every run of ``window`` words is the beginning of a suffix of its text. Two of them are equal if
the suffixes share a node of the corpus's suffix tree at that depth, so what repeats is what lies
below an internal node that deep. The tree is never built whole:

* Each window has an anchor: of the runs of ``SEED`` words in it, the one of the smallest hash, the
  first on ties. Equal windows have their anchors at the same place, so windows whose anchors'
  words differ cannot be equal. One in ten words begins an anchor, and neighbours share theirs.
* Prefixes are of variable length. The words of an anchor are the first; how often each occurs is
  counted. Suffixes whose prefix is unique are done: nothing repeats there.
* Prefixes that occur up to ``GROUP`` times make a group each, which a task can hold. Its subtree
  needs no spelled-out edges, as it is looked at in one depth only: a node is named by the 64-bit
  hash of its path, the window, and an internal node is a name that two suffixes have.
* More frequent prefixes are extended to the whole window. There, counting the names is enough,
  so no group of them comes together, however many suffixes share one.

The union of a text's deep windows are its maximal repeats. Texts are read where they lie; only
those that hold repeated anchors, and at the end those that lose words, are shuffled.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.words import Words, mix, text_slices, words_of

WINDOW = 35
SEED = 12
#: Suffixes that a task may hold together, about a hundred bytes each.
GROUP = 1 << 16

_STEP = np.uint64(0xD1342543DE82EF95)


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes, by doubling: of n words from those of n // 2."""
    if n == 1:
        return mix(hashes)
    half = _grams(hashes, n // 2)
    power = np.uint64(pow(int(_STEP), n // 2, 1 << 64))
    long = max(0, len(hashes) - n + 1)
    out = half[:long] * power + half[n // 2 : n // 2 + long]
    if n % 2:
        out = out * _STEP + mix(hashes)[n - 1 : n - 1 + long]
    return mix(out)


def _first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Index of the smallest of ``width`` values from each place on, the first on ties."""
    best = np.arange(len(values))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[: len(best) - step], best[step:]
        best = np.where(values[left] <= values[right], left, right)
        reach += step
    return best


@dataclass
class Anchors:
    """Anchors of the texts of a slice. The windows of one start at ``first``, ``n`` in a row."""

    at: np.ndarray
    first: np.ndarray
    n: np.ndarray
    doc: np.ndarray
    #: Each text's first word.
    begins: np.ndarray
    seeds: np.ndarray
    paths: np.ndarray


def anchors_of(found: Words, window: int, seed: int) -> Anchors:
    h, doc = found.hashes, found.doc
    begins = np.concatenate(([0], np.cumsum(found.per_doc())))
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return Anchors(none, none, none, none, begins, none.view(np.uint64), none.view(np.uint64))
    seeds, paths = _grams(h, seed), _grams(h, window)
    whole = np.flatnonzero(doc[: len(paths)] == doc[window - 1 :])
    at = _first_smallest(seeds, window - seed + 1)[whole]
    new = np.ones(len(at), bool)
    new[1:] = at[1:] != at[:-1]
    change = np.flatnonzero(new)
    n = np.diff(np.append(change, len(at)))
    at = at[change]
    return Anchors(at, whole[change], n, doc[at], begins, seeds[at], paths)


def _lists(values: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.Array:
    """Lists of ``n`` values from each start."""
    offsets = np.concatenate(([0], np.cumsum(n)))
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], n)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values[at].view(np.int64)))


def _rows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text``: row stands for both, so that rows of one doc_id stay apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), text.alias("text"))


def _wanted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose ``row`` is in ``keys``, and a few others."""
    bits = shared.bit_filter(keys, F.col("row"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = np.flatnonzero(shared.may_hold(bits, batch.column(1).to_numpy()))
            yield batch.take(pa.array(use))

    return rows.mapInArrow(pick, rows.schema)


def _hits(rows: DataFrame, window: int, seed: int, group: int) -> DataFrame:
    """``row, at``: places of a text's anchors whose words occur again.

    A place is its word's number doubled, plus one if the anchor is one of more than ``group``.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0).to_numpy()
            for low, _, data, offsets in text_slices(batch.column(1)):
                found = anchors_of(words_of(data, offsets, lower=False), window, seed)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row[low + found.doc]),
                        pa.array(found.at - found.begins[found.doc], pa.int64()),
                        pa.array(found.seeds.view(np.int64)),
                    ],
                    ["row", "at", "seed"],
                )

    anchors = shared.stored(
        rows.select("row", "text").mapInArrow(find, "row long, at long, seed long"), "anchors"
    )
    again = anchors.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = shared.stored(
        again.select("seed", (F.col("n") > group).cast("int").alias("crowded")), "prefixes"
    )
    place = 2 * F.col("at") + F.col("crowded")
    hits = anchors.join(again, "seed").groupBy("row").agg(F.collect_set(place).alias("at"))
    return shared.stored(hits, "hits")


def _suffixes(rows: DataFrame, hits: DataFrame, crowded: int, window: int, seed: int) -> DataFrame:
    """``prefix, doc_id, row, first, paths``: the windows of the anchors in ``hits``, by anchor.

    Windows start at ``first`` and the words after it; ``paths`` names each.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, row = batch.column(0), batch.column(1)
            for low, high, data, offsets in text_slices(batch.column(2)):
                found = anchors_of(words_of(data, offsets, lower=False), window, seed)
                lists = batch.column(3)[low:high]
                of = np.repeat(np.arange(high - low), np.diff(lists.offsets.to_numpy()))
                hit = lists.flatten().to_numpy()
                own = found.begins[of] + (hit >> 1)
                use = np.flatnonzero(np.isin(found.at, own[hit & 1 == crowded]))
                at = pa.array(low + found.doc[use])
                first = found.first[use]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.seeds[use].view(np.int64)),
                        doc_id.take(at),
                        row.take(at),
                        pa.array(first - found.begins[found.doc[use]], pa.int64()),
                        _lists(found.paths, first, found.n[use]),
                    ],
                    ["prefix", "doc_id", "row", "first", "paths"],
                )

    with_hits = _wanted(rows, hits).join(hits, "row").select("doc_id", "row", "text", "at")
    return with_hits.mapInArrow(
        cut, "prefix long, doc_id long, row long, first long, paths array<long>"
    )


def _spans_of(batch: pa.Table, window: int) -> pa.RecordBatch:
    """Spans of the deep internal nodes of whole groups."""
    lists = batch["paths"].combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    path = lists.flatten().to_numpy()
    n = np.diff(lists.offsets.to_numpy())
    suffix = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(path)) - np.repeat(np.cumsum(n) - n, n)
    start += batch["first"].to_numpy()[suffix]
    # Suffixes in the order of their paths are the leaves of the subtrees; a path that the next
    # leaf shares is an internal node.
    order = np.argsort(path, kind="stable")
    same = path[order][1:] == path[order][:-1]
    deep = np.zeros(len(path), bool)
    deep[order[1:][same]] = True
    deep[order[:-1][same]] = True
    use = np.flatnonzero(deep)
    new = np.ones(len(use), bool)
    new[1:] = (suffix[use][1:] != suffix[use][:-1]) | (np.diff(use) != 1)
    low = use[new]
    high = use[np.append(np.flatnonzero(new)[1:], len(use)) - 1] if len(use) else use
    of = pa.array(suffix[low])
    return pa.RecordBatch.from_arrays(
        [
            batch["doc_id"].combine_chunks().take(of),
            batch["row"].combine_chunks().take(of),
            pa.array(start[low], pa.int64()),
            pa.array(start[high] + window, pa.int64()),
        ],
        ["doc_id", "row", "begin", "end"],
    )


def _subtrees(suffixes: DataFrame, window: int) -> DataFrame:
    """``doc_id, row, begin, end``: what repeats within the groups, streamed group after group."""
    n = shared.partitions(suffixes.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            prefix = batch.column(0).to_numpy()
            if not len(prefix):
                continue
            last = int(np.searchsorted(prefix, prefix[-1]))  # the last group may go on
            if last or (held and held[-1].column(0)[-1].as_py() != prefix[0]):
                yield _spans_of(pa.Table.from_batches([*held, batch.slice(0, last)]), window)
                held = []
            held.append(batch.slice(last))
        if held:
            yield _spans_of(pa.Table.from_batches(held), window)

    grouped = suffixes.repartition(n, "prefix").sortWithinPartitions("prefix")
    return grouped.mapInArrow(walk, "doc_id long, row long, begin long, end long")


def _counted(suffixes: DataFrame, window: int) -> DataFrame:
    """``doc_id, row, begin, end``: what repeats among suffixes of crowded prefixes."""
    windows = shared.stored(
        suffixes.select("doc_id", "row", "first", F.posexplode("paths").alias("k", "path")).select(
            "doc_id", "row", (F.col("first") + F.col("k")).alias("begin"), "path"
        ),
        "windows",
    )
    again = windows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = shared.stored(again.select("path"), "paths")
    return windows.join(again, "path").select(
        "doc_id", "row", "begin", (F.col("begin") + window).alias("end")
    )


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, seed: int = SEED, group: int = GROUP
) -> DataFrame:
    """``doc_id, row, spans`` of texts that hold a run of ``window`` words found elsewhere, too.

    Spans are (begin, end) in words; they may overlap, and their union is all that repeats.
    ``row`` is xxhash64(doc_id, text), null texts being empty.
    """
    shared.ship(docs.sparkSession)
    rows = _rows(docs)
    hits = _hits(rows, window, seed, group)
    spans = _subtrees(_suffixes(rows, hits, 0, window, seed), window)
    crowded = hits.filter(F.exists("at", lambda x: x % 2 == 1))
    if not crowded.isEmpty():
        spans = spans.unionByName(_counted(_suffixes(rows, crowded, 1, window, seed), window))
    per_text = spans.groupBy("doc_id", "row").agg(
        F.collect_set(F.struct("begin", "end")).alias("spans")
    )
    return shared.stored(per_text, "spans")


def _kept(found: Words, covered: np.ndarray) -> pa.Array:
    """Texts of the words that are not covered, joined by one space."""
    words = np.flatnonzero(~covered)
    doc, length = found.doc[words], (found.ends - found.starts)[words]
    space = np.zeros(len(words), np.int64)
    space[1:] = doc[1:] == doc[:-1]
    ends = np.cumsum(length + space)
    out = np.full(ends[-1] if len(ends) else 0, 32, np.uint8)
    total = np.cumsum(length)
    byte = np.arange(total[-1] if len(total) else 0) - np.repeat(total - length, length)
    out[byte + np.repeat(ends - length, length)] = found.data[
        byte + np.repeat(found.starts[words], length)
    ]
    per_doc = np.bincount(doc, length + space, found.n_docs).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(per_doc))).astype(np.int32)
    return pa.Array.from_buffers(
        pa.string(), found.n_docs, [None, pa.py_buffer(offsets), pa.py_buffer(out)]
    )


_OUT = "doc_id long, n_words long, n_removed long, kept_text string"


def _removed(doc_id: pa.Array, data: np.ndarray, offsets: np.ndarray, spans: np.ndarray):
    """``spans`` has columns text, begin and end."""
    found = words_of(data, offsets, lower=False)
    n_words = found.per_doc()
    first = np.concatenate(([0], np.cumsum(n_words)))[spans[:, 0]]
    depth = np.zeros(len(found.doc) + 1, np.int64)
    np.add.at(depth, first + spans[:, 1], 1)
    np.add.at(depth, first + spans[:, 2], -1)
    covered = np.cumsum(depth[:-1]) > 0
    return pa.RecordBatch.from_arrays(
        [
            doc_id,
            pa.array(n_words, pa.int64()),
            pa.array(np.bincount(found.doc[covered], minlength=found.n_docs), pa.int64()),
            _kept(found, covered),
        ],
        [c.split()[0] for c in _OUT.split(", ")],
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, **parameters) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row of ``docs`` (doc_id, text).

    A word is removed if a run of ``window`` consecutive words of its text that covers it begins
    anywhere else, too, in this text or another; all runs are judged on the input. What is left is
    joined by single spaces. Words are those between blanks, unchanged. A null or empty text has
    none; a text shorter than the window loses nothing. Repeated rows are texts each, and so lose
    all they have from the window on; a row without doc_id is a text like others. Other columns
    are not looked at.
    """
    rows = _rows(docs)
    spans = repeated_spans(docs, window, **parameters)
    bits = shared.bit_filter(spans, F.col("row"))
    none = np.zeros((0, 3), np.int64)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.take(pa.array(np.flatnonzero(~shared.may_hold(bits, batch.column(1).to_numpy()))))
            for low, high, data, offsets in text_slices(batch.column(2)):
                yield _removed(batch.column(0)[low:high], data, offsets, none)

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                lists = batch.column(2)[low:high]
                n = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
                pairs = lists.flatten()
                ends = [pairs.field(k).to_numpy() for k in (0, 1)]
                of = np.repeat(np.arange(high - low), n)
                yield _removed(
                    batch.column(0)[low:high], data, offsets, np.stack([of, *ends], 1).astype(np.int64)
                )

    named = spans.select(
        F.col("doc_id").alias("span_id"), F.col("row").alias("span_row"), "spans"
    )
    picked = _wanted(rows, spans)
    same: Column = picked["doc_id"].eqNullSafe(F.col("span_id")) & (picked["row"] == F.col("span_row"))
    changed = picked.join(named, same, "left").select("doc_id", "text", "spans")
    return rows.mapInArrow(untouched, _OUT).unionByName(changed.mapInArrow(touched, _OUT))
