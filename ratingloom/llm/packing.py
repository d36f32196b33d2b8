"""Packing documents into token sequences along a Hilbert curve.

Hashed word vectors are projected to ``DIMS`` dimensions, and their Hilbert index is a
document's place on the curve, so neighbours on it share words. Documents are range-partitioned
and sorted by it, with the id breaking ties, so that equal documents may spread over partitions.
Each partition then streams its documents into sequences, cutting them where a sequence is full.
What is left at its end is cut into sequences whose lengths are powers of two, which need no
padding. Only one slice of texts and one open sequence are held at a time.
"""

import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratingloom.llm import shared
from ratingloom.llm.words import mix, text_slices, words_of

LENGTH = 4096
END_ID = 2
DIMS = 4
DIM_BITS = 10
#: Words met lately whose ids a Python worker keeps, and at most as many older ones.
_KEPT = 1 << 19
#: A kept word has at most ``8 * _LANES`` bytes and ``_IDS`` ids.
_LANES, _IDS = 3, 11
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_TOGETHER = 1000
#: Bytes of text encoded at once; what a worker needs meanwhile is some 100 times as much.
_SLICE = 1 << 19
_SEQUENCES_PER_PARTITION = 1 << 32
#: Documents drawn to cut the curve into ranges: for each range, and in all.
_PER_RANGE = 200
_DRAWN = 1_000_000


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer points (n, dims) with ``bits`` bits a dimension.

    J. Skilling, "Programming the Hilbert curve", 2004, on whole columns.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> bit) & 1)
    return index


def _keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert keys of texts; 0 for one without words."""
    found = words_of(data, offsets)
    n = np.maximum(found.per_doc(), 1)
    points = np.empty((found.n_docs, DIMS), np.int64)
    for d in range(DIMS):
        # A word adds one of sixteen centred weights in each dimension.
        weight = ((found.hashes >> np.uint64(4 * d)) & np.uint64(15)).astype(np.int8) - 7.5
        mean = np.bincount(found.doc, weight, found.n_docs) / n
        points[:, d] = np.clip((mean + 3.0) / 6.0 * (1 << DIM_BITS), 0, (1 << DIM_BITS) - 1)
    return np.where(found.per_doc() > 0, hilbert_index(points, DIM_BITS), 0)


_LEAST_ID = -(2**63)


def _curve_bounds(texts: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``n - 1`` pairs (place, doc_id) that cut the curve into ranges of as many bytes.

    They come from some ``_PER_RANGE`` documents a range, drawn by a hash, at most ``_DRAWN`` in
    all. They decide which task packs a document, nothing else.
    """
    rows = texts.count()
    share = min(1.0, min(_PER_RANGE * n, _DRAWN) / max(rows, 1))
    drawn = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(_keys(data, offsets), pa.int64()),
                        batch.column(0)[low:high].fill_null(_LEAST_ID),
                        pa.array(np.diff(offsets) + 64, pa.int64()),
                    ],
                    ["place", "doc_id", "size"],
                )

    found = texts.filter(drawn).mapInArrow(place, "place long, doc_id long, size long").toArrow()
    places, ids, size = (found[c].to_numpy() for c in ("place", "doc_id", "size"))
    order = np.lexsort((ids, places))
    total = np.cumsum(size[order])
    if not len(total):
        return places, ids
    cuts = np.searchsorted(total, total[-1] * np.arange(1, n) / n)
    cuts = order[np.unique(cuts)]
    return places[cuts], ids[cuts]


def _range_of(places: np.ndarray, ids: np.ndarray, bounds: tuple[np.ndarray, np.ndarray]):
    """The range of each (place, id): the number of bounds below it."""
    low = np.searchsorted(bounds[0], places, "left")
    high = np.searchsorted(bounds[0], places, "right")
    for place in np.unique(places[low < high]):
        of = np.flatnonzero(places == place)
        own = slice(low[of[0]], high[of[0]])
        low[of] += np.searchsorted(bounds[1][own], ids[of], "left")
    return low


def along_curve(docs: DataFrame) -> DataFrame:
    """``doc_id, text, place`` in curve order, range-partitioned.

    Documents of one place are told apart by their ids, so a crowded place is split over ranges.
    """
    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    n = shared.partitions(docs.sparkSession)
    bounds = docs.sparkSession.sparkContext.broadcast(_curve_bounds(texts, n))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                ids = batch.column(0)[low:high]
                places = _keys(data, offsets)
                ranges = _range_of(places, ids.fill_null(_LEAST_ID).to_numpy(), bounds.value)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        batch.column(1)[low:high],
                        pa.array(places, pa.int64()),
                        pa.array(ranges, pa.int32()),
                    ],
                    ["doc_id", "text", "place", "range"],
                )

    placed = texts.mapInArrow(place, "doc_id long, text string, place long, range int")
    return (
        placed.repartitionById(n, "range")
        .sortWithinPartitions("place", "doc_id", "text")
        .drop("range")
    )


class _Kept:
    """Words and their ids, each in the slot its hash gives; a word there before makes room.

    A word's bytes are kept in ``_LANES`` integers and compared whole, so no two are confused.
    Words of more bytes, or of more than ``_IDS`` ids, are not kept.
    """

    def __init__(self, slots: int, kind: np.dtype):
        self.length = np.zeros(slots, np.uint8)
        self.lanes = [np.zeros(slots, np.uint64) for _ in range(_LANES)]
        self.counts = np.zeros(slots, np.uint8)
        self.ids = np.zeros((slots, _IDS), kind)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.length))

    def holds(self, slot: np.ndarray, length: np.ndarray, lanes: list[np.ndarray]) -> np.ndarray:
        """Which words are in their slots."""
        same = (self.length[slot] == length) & (self.lanes[0][slot] == lanes[0])
        for k in range(1, _LANES):
            more = np.flatnonzero(same & (length > 8 * k))
            same[more] = self.lanes[k][slot[more]] == lanes[k][more]
        return same

    def columns(self) -> list[np.ndarray]:
        return [self.length, *self.lanes, self.counts, self.ids]


def _lanes(data: bytes, starts: np.ndarray, length: np.ndarray) -> list[np.ndarray]:
    """The first ``8 * _LANES`` bytes of words as integers, with zeros after a word's end."""
    size = len(data) - 7
    at_byte = np.ndarray((size,), "<u8", data, strides=(1,))
    lanes = []
    for k in range(_LANES):
        lane = np.zeros(len(starts), np.uint64)
        some = np.flatnonzero(length > 8 * k) if k else slice(None)
        lane[some] = at_byte[starts[some] + 8 * k] & _FIRST[np.minimum(length[some] - 8 * k, 8)]
        lanes.append(lane)
    return lanes


class WordTokens:
    """Token ids of words as bytes of unsigned 32-bit little-endian integers.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its
    words. Words are encoded once while they are kept: those of letters only many at a time,
    told apart by the marks that end words in the vocabulary. Of the words of one slot, the last
    met is in ``known`` and the one before in ``older``.

    A text that holds one of the tokenizer's added tokens, which are matched before anything else,
    is encoded whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Lower-cased words that only look like an added token are words.
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.slots = 1 << (_KEPT - 1).bit_length()
        kind = np.min_scalar_type(len(self.last))
        self.known, self.older = _Kept(self.slots, kind), _Kept(self.slots, kind)
        self.marks = {c: self._single([c])[0] for c in string.punctuation}

    def _single(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _letters(self, words: list[str]) -> list[bytes]:
        parts = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        joined = [" ".join(part) for part in parts]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        out: list[bytes] = []
        for part, e in zip(parts, encoded):
            ids = np.array(e.ids, "<u4")
            cuts = (np.flatnonzero(self.last[ids]) + 1) * 4
            if len(cuts) != len(part):
                out += self._single(part)
                continue
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        out = [b""] * len(words)
        letters: dict[str, list[tuple[int, bytes]]] = {}
        other: list[tuple[int, str]] = []
        for i, word in enumerate(words):
            text = word.decode()
            if text.isalpha():
                letters.setdefault(text, []).append((i, b""))
            elif text[-1] in self.marks and text[:-1].isalpha():
                letters.setdefault(text[:-1], []).append((i, self.marks[text[-1]]))
            else:
                other.append((i, text))
        for text, ids in zip(letters, self._letters(list(letters))):
            for i, mark in letters[text]:
                out[i] = ids + mark
        for (i, _), ids in zip(other, self._single([text for _, text in other])):
            out[i] = ids
        return out

    def _keep(self, slot, length, lanes, counts, first, flat) -> None:
        """Put new words, whose ids are ``flat``, into their slots; what was there becomes older."""
        able = np.flatnonzero((length <= 8 * _LANES) & (counts <= _IDS))
        slot, one = np.unique(slot[able], return_index=True)
        able = able[one]
        used = np.arange(_IDS) < counts[able, None]
        ids = np.zeros(used.shape, self.known.ids.dtype)
        ids[used] = flat[_spread(first[able], counts[able])]
        new = [length[able], *(lane[able] for lane in lanes), counts[able], ids]
        for known, older, column in zip(self.known.columns(), self.older.columns(), new):
            older[slot] = known[slot]
            known[slot] = column

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts."""
        whole = {
            i
            for token in self.added
            for i, text in enumerate(texts)
            if token in text
        }
        if whole:
            plain = self.encode([b"" if i in whole else text for i, text in enumerate(texts)])
            self.tokenizer.encode_special_tokens = False
            for i in whole:
                plain[i] = self._single([texts[i].decode()])[0]
            self.tokenizer.encode_special_tokens = True
            return plain
        offsets = np.cumsum([0, *map(len, texts)])
        found = words_of(np.frombuffer(b"".join(texts), np.uint8), offsets, with_hashes=False)
        starts, length = found.starts, found.ends - found.starts
        raw = found.data.tobytes() + bytes(8 * _LANES)
        lanes = _lanes(raw, starts, length)
        slot = mix(sum(lane * odd for lane, odd in zip(lanes, _ODD)) + length.astype(np.uint64))
        slot = (slot & np.uint64(self.slots - 1)).astype(np.int64)
        counts = np.zeros(len(starts), np.int64)
        sources: list[tuple[np.ndarray, np.ndarray]] = []
        left = np.arange(len(starts))
        for kept in (self.known, self.older):
            hit = kept.holds(slot[left], length[left], [lane[left] for lane in lanes])
            of, left = left[hit], left[~hit]
            counts[of] = n = kept.counts[slot[of]]
            sources.append((of, kept.ids[slot[of]][np.arange(_IDS) < n[:, None]]))
        number: dict[bytes, int] = {}
        spans = zip(starts[left].tolist(), found.ends[left].tolist())
        which = np.array([number.setdefault(raw[a:b], len(number)) for a, b in spans], np.int64)
        new = self._words(list(number))
        sizes = np.array([len(ids) // 4 for ids in new], np.int64)
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(new), "<u4")
        counts[left] = sizes[which]
        sources.append((left, flat[_spread(first[which], sizes[which])]))
        if len(left):
            _, one = np.unique(which, return_index=True)
            one = left[one]
            self._keep(slot[one], length[one], [lane[one] for lane in lanes], sizes, first, flat)
        out = np.empty(int(counts.sum()), "<u4")
        for of, ids in sources:
            mine = np.zeros(len(starts), bool)
            mine[of] = True
            out[np.repeat(mine, counts)] = ids
        ends = np.concatenate(([0], np.cumsum(counts)))
        cuts = 4 * ends[np.concatenate(([0], np.cumsum(found.per_doc())))]
        joined, cuts = out.tobytes(), cuts.tolist()
        return [joined[a:b] for a, b in zip(cuts, cuts[1:])]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``starts`` and have ``counts`` items, end to end."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def word_tokens(path: str) -> WordTokens:
    """The tokenizer of a file, loaded once in a Python worker."""
    held = shared.only("packing")
    if path not in held:
        # A task has one core; threads for all of a machine's cores cost time and memory.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        held[path] = WordTokens(path)
    return held[path]


class _Packer:
    """Sequences of one partition. Pieces are (document, start, length); ids lie end to end."""

    def __init__(self, length: int):
        self.length = length
        self.sequence = TaskContext.get().partitionId() * _SEQUENCES_PER_PARTITION
        self.ids = b""
        self.docs: list[tuple[int | None, int, int, int]] = []  # id, start, length, tokens

    def add(self, ids: list[int | None], encoded: list[bytes], end: bytes):
        encoded = [e + end for e in encoded]
        self.docs += [(i, 0, len(e) // 4, len(e) // 4) for i, e in zip(ids, encoded)]
        self.ids = b"".join((self.ids, *encoded))
        full = len(self.ids) // 4 // self.length
        return self._cut([self.length] * full)

    def finish(self):
        left = len(self.ids) // 4
        return self._cut([1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1])

    def _cut(self, lengths: list[int]) -> pa.RecordBatch:
        rows = []
        docs, at, k = self.docs, 0, 0
        doc, start, size, tokens = docs[0] if docs else (None, 0, 0, 0)
        for length in lengths:
            offset = 0
            while offset < length:
                take = min(size, length - offset)
                crc = zlib.crc32(self.ids[4 * at : 4 * (at + take)])
                rows.append((doc, start, take, crc, tokens, self.sequence, offset))
                at, offset, start, size = at + take, offset + take, start + take, size - take
                if not size:
                    k += 1
                    doc, start, size, tokens = docs[k] if k < len(docs) else (None, 0, 0, 0)
            self.sequence += 1
        self.docs = ([(doc, start, size, tokens)] if size else []) + docs[k + 1 :]
        self.ids = self.ids[4 * at :]
        columns = list(zip(*rows)) or [()] * 7
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], _PIECE)


_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Pieces ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Every row of ``docs`` (doc_id, text) gives its token ids followed by ``END_ID``; a null or
    empty text gives that one id. Pieces cover each document's ids once. Sequences hold ``length``
    ids, or a power of two at the end of a partition, so none is padded. Rows that repeat are
    packed each. A null doc_id stays null. Other columns of ``docs`` are not looked at.
    """
    shared.ship(docs.sparkSession)
    shared.small_batches(docs.sparkSession)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer = word_tokens(tokenizer_path), _Packer(length)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, data, offsets in text_slices(batch.column(1), _SLICE):
                raw = data.tobytes()
                at = offsets.tolist()
                texts = [raw[a:b] for a, b in zip(at, at[1:])]
                yield packer.add(ids[low:high], tokens.encode(texts), end)
        yield packer.finish()
        shared.trim()

    return along_curve(docs).drop("place").mapInArrow(
        stream, ", ".join(f"{name} long" for name in _PIECE)
    )
