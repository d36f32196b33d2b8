"""Language identification by unigrams over a fixed vocabulary, all segmentations summed.

Each language has a probability for every piece of a public vocabulary. The probability of a word
is the sum over all ways to cut it into pieces, which a forward pass over its bytes adds up; the
text's is the product over its words. Probabilities come from expected piece counts: a
forward-backward pass over every distinct word of a task, weighted by its count in each language.

Words start with a space, as the vocabulary's word-initial pieces do. Every single byte is a
piece, so each word has at least one segmentation.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.words import Words, byte_hashes, span_hashes, text_slices, words_of

UNKNOWN = "und"
#: Expected counts are smoothed by so many counts spread as the pieces of all languages are.
SMOOTHING = 1000.0
#: Bytes of text looked at together; a worker needs some 50 times as much meanwhile.
_SLICE = 1 << 20
_PENDING = 100_000
_KEPT = 300_000
_BITS = 21


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model that can occur in lower-cased words, and all bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ").encode()
        if b" " not in piece[1:]:
            pieces.add(piece.lower())
    return sorted(pieces)


class Pieces:
    """Lookup of piece numbers by span hash; the number of pieces stands for "no piece"."""

    def __init__(self, pieces: list[bytes]):
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum([len(p) for p in pieces])
        starts = ends - np.array([len(p) for p in pieces])
        self.hashes = span_hashes(byte_hashes(data), starts, ends)
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        self.keys = np.append(self.hashes, np.uint64(0))
        self.tables = []
        left = np.arange(self.n)
        for shift in (64 - _BITS, 64 - 2 * _BITS, 0):
            table = np.full(1 << _BITS, self.n, np.int32)
            table[self._slot(self.hashes[left], shift)] = left
            self.tables.append((shift, table))
            left = left[table[self._slot(self.hashes[left], shift)] != left]
        if len(left):
            raise ValueError("vocabulary too large for its tables")

    @staticmethod
    def _slot(h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> np.uint64(shift)) & np.uint64((1 << _BITS) - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        shift, table = self.tables[0]
        ids = table[self._slot(h, shift)]
        miss = np.flatnonzero(self.keys[ids] != h)
        for shift, table in self.tables[1:]:
            ids[miss] = table[self._slot(h[miss], shift)]
            miss = miss[self.keys[ids[miss]] != h[miss]]
        ids[miss] = self.n
        return ids


def _by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray]]:
    """Groups of words of one length: their numbers, the length, running hash, starts."""
    lengths = np.array([len(w) for w in words]) + 1
    order = np.argsort(lengths, kind="stable")
    low = 0
    while low < len(order):
        n = lengths[order[low]]
        high = int(np.searchsorted(lengths[order], n, "right"))
        # Bounded work space: spans times words.
        high = min(high, low + max(1, (1 << 16) // int(n)))
        of = order[low:high]
        data = np.frombuffer(b"".join(b" " + words[i] for i in of), np.uint8)
        yield of, int(n), byte_hashes(data), np.arange(len(of)) * n
        low = high


def _lattice(pieces: Pieces, n: int, total: np.ndarray, starts: np.ndarray):
    """By end: (begin, piece numbers) of the spans in which any of the words has a piece."""
    ends: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n + 1)]
    for size in range(1, min(pieces.longest, n) + 1):
        begins = np.arange(n - size + 1)
        at = (begins[:, None] + starts[None, :]).ravel()
        ids = pieces.find(span_hashes(total, at, at + size)).reshape(len(begins), len(starts))
        some = (ids != pieces.n).any(1)
        for i in begins[some]:
            ends[i + size].append((int(i), ids[i]))
    return ends


def _forward(lattice, table: np.ndarray, n: int, words: int, longest: int):
    """Scaled forward values by position, and the logarithm of what each was divided by.

    ``longest`` is the length of the longest piece: no position looks further back.
    """
    alpha = np.zeros((n + 1, words, table.shape[1]))
    alpha[0] = 1.0
    scale = np.zeros((n + 1, words, 1))
    running = np.zeros((words, 1))
    for end in range(1, n + 1):
        for begin, ids in lattice[end]:
            alpha[end] += alpha[begin] * table[ids]
        if end % 16 == 0 and end < n:
            # Divide all values that later positions can still see by one common factor.
            seen = slice(max(0, end - longest), end + 1)
            top = alpha[seen].max((0, 2))[:, None]
            alpha[seen] /= top
            running = running + np.log(top)
            scale[seen] = running
        else:
            scale[end] = running
    return alpha, scale


def word_scores(pieces: Pieces, table: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural logarithm of each word's probability in each language."""
    out = np.empty((len(words), table.shape[1]))
    for of, n, total, starts in _by_length(words):
        alpha, scale = _forward(
            _lattice(pieces, n, total, starts), table, n, len(of), pieces.longest
        )
        out[of] = np.log(np.maximum(alpha[n], 1e-300)) + scale[n]
    return out


def expected_counts(
    pieces: Pieces, table: np.ndarray, words: list[bytes], weights: np.ndarray
) -> np.ndarray:
    """Expected number of times each piece is used, for each column of ``weights``."""
    n_out = weights.shape[1]
    out = np.zeros((pieces.n + 1, n_out))
    for of, n, total, starts in _by_length(words):
        lattice = _lattice(pieces, n, total, starts)
        alpha, scale = _forward(lattice, table, n, len(of), pieces.longest)
        end_value, end_scale = np.maximum(alpha[n], 1e-300), scale[n]
        # Backward values relative to the end, kept in the forward pass's scale.
        beta = np.zeros_like(alpha)
        beta[n] = 1.0 / end_value
        ids_all, share_all = [], []
        for end in range(n, 0, -1):
            for begin, ids in lattice[end]:
                step = table[ids] * beta[end] * np.exp(scale[begin] - scale[end])
                beta[begin] += step
                ids_all.append(ids)
                share_all.append(alpha[begin] * step)
        ids = np.concatenate(ids_all)
        share = np.concatenate(share_all)
        for k in range(n_out):
            weight = np.tile(weights[of, k], len(ids_all))
            use = share[:, min(k, share.shape[1] - 1)] * weight
            out[:, k] += np.bincount(ids, use, pieces.n + 1)
    return out[:-1]


def _pieces(broadcast) -> Pieces:
    """The lookup tables of a broadcast vocabulary, built once in a Python worker."""
    built = shared.only("langid")
    key = zlib.crc32(b"\n".join(broadcast.value))
    if key not in built:
        built.clear()
        built[key] = Pieces(broadcast.value)
    return built[key]


def _distinct(found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.unique(found.hashes, return_index=True, return_inverse=True)


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _train(docs: DataFrame, langs: list[str], vocab, n_pieces: int) -> np.ndarray:
    """Piece probabilities, one column per language, from all training texts.

    The table is bounded by vocabulary times languages, whatever the corpus.
    """
    n_langs = len(langs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces(vocab)
        flat = np.full((pieces.n + 1, 1), 1.0 / pieces.n)
        flat[-1] = 0.0
        sums = np.zeros((pieces.n, n_langs))
        index: dict[int, int] = {}
        words: list[bytes] = []
        weights = np.zeros((_PENDING, n_langs))

        def flush():
            nonlocal sums
            if words:
                sums += expected_counts(pieces, flat, words, weights[: len(words)])
            index.clear()
            words.clear()
            weights[:] = 0.0

        for batch in batches:
            lang_of = {lang: i for i, lang in enumerate(langs)}
            lang = np.array([lang_of[x] for x in batch.column(1).to_pylist()], np.int64)
            for low, high, data, offsets in text_slices(batch.column(0), _SLICE):
                found = words_of(data, offsets)
                if not len(found.hashes):
                    continue
                distinct, first, inverse = _distinct(found)
                tally = np.bincount(
                    inverse * n_langs + lang[low:high][found.doc],
                    minlength=len(distinct) * n_langs,
                ).reshape(-1, n_langs)
                begin = 0
                while begin < len(distinct):
                    room = _PENDING - len(words)
                    part = slice(begin, min(len(distinct), begin + max(room, 1)))
                    if not room:
                        flush()
                        continue
                    at = np.empty(part.stop - part.start, np.int64)
                    for j, h in enumerate(distinct[part].tolist()):
                        k = index.get(h)
                        if k is None:
                            k = index[h] = len(words)
                            words.append(found.text(first[begin + j]))
                        at[j] = k
                    weights[at] += tally[part]
                    begin = part.stop
        flush()
        piece, lang_no = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(piece, pa.int32()),
                pa.array(lang_no, pa.int32()),
                pa.array(sums[piece, lang_no], pa.float64()),
            ],
            ["piece", "lang", "n"],
        )
        shared.trim()

    counted = (
        docs.select("text", "lang")
        .mapInArrow(count, "piece int, lang int, n double")
        .groupBy("piece", "lang")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    sums = np.zeros((n_pieces, n_langs))
    sums[counted["piece"].to_numpy(), counted["lang"].to_numpy()] = counted["n"].to_numpy()
    overall = sums.sum(1) + 0.01
    smooth = SMOOTHING * overall / overall.sum()
    return (sums + smooth[:, None]) / (sums.sum(0) + SMOOTHING)


def _has_letter(found: Words, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = (found.data >= 97) & (found.data <= 122)
    seen = np.concatenate(([0], np.cumsum(ascii_letter)))
    out = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)):
        raw = found.data[offsets[i] : offsets[i + 1]].tobytes()
        out[i] = any(map(str.isalpha, raw.decode("utf-8", "replace")))
    return out


class _Scores:
    """Word scores of a task, those of recently met words kept."""

    def __init__(self, pieces: Pieces, table: np.ndarray):
        self.pieces, self.table = pieces, table
        self.known = np.zeros(0, np.uint64)
        self.values = np.zeros((0, table.shape[1]), np.float32)

    def of(self, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the distinct words, and each word's place among them."""
        distinct, first, inverse = _distinct(found)
        at = np.minimum(np.searchsorted(self.known, distinct), max(0, len(self.known) - 1))
        hit = self.known[at] == distinct if len(self.known) else np.zeros(len(distinct), bool)
        out = np.empty((len(distinct), self.table.shape[1]), np.float32)
        out[hit] = self.values[at[hit]]
        miss = np.flatnonzero(~hit)
        if len(miss):
            words = [found.text(i) for i in first[miss]]
            out[miss] = word_scores(self.pieces, self.table, words)
            if len(self.known) + len(miss) > _KEPT:
                self.known, self.values = distinct, out
            else:
                known = np.concatenate((self.known, distinct[miss]))
                order = np.argsort(known, kind="stable")
                self.known = known[order]
                self.values = np.concatenate((self.values, out[miss]))[order]
        return out, inverse


def identify(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (doc_id, text, lang).

    Training rows have a lang, a text, and a crc32(doc_id as text) that is not 2 modulo 4; the
    others with 2 are held out. A row without doc_id is not held out. ``score`` is the posterior
    probability of the predicted language. A text that is null or has no letter is ``und`` with
    score 0, and so is all if there is no training row. Other columns are not looked at.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    shared.small_batches(spark)
    docs = docs.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.col("lang").cast("string"),
        _held_out(F.col("doc_id")).alias("held_out"),
    )
    training = docs.filter("not held_out and lang is not null and text is not null")
    rows = training.groupBy("lang").count().orderBy("lang").collect()
    langs, prior = [r[0] for r in rows], np.array([float(r[1]) for r in rows])
    pieces = vocabulary(vocabulary_path)
    vocab = spark.sparkContext.broadcast(pieces)
    model = None
    if langs:
        table = _train(training, langs, vocab, len(pieces))
        model = spark.sparkContext.broadcast(np.vstack((table, np.zeros(len(langs)))))
        prior = np.log(prior / prior.sum())

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*langs, UNKNOWN], object)
        scores = _Scores(_pieces(vocab), model.value) if langs else None
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1), _SLICE):
                n = high - low
                best, score = np.full(n, len(langs)), np.zeros(n)
                found = words_of(data, offsets)
                if langs and len(found.hashes):
                    values, inverse = scores.of(found)
                    logs = np.empty((n, len(langs)))
                    for k in range(len(langs)):
                        logs[:, k] = np.bincount(found.doc, values[inverse, k], n) + prior[k]
                    top = logs.max(1)
                    letters = _has_letter(found, offsets)
                    best[letters] = logs.argmax(1)[letters]
                    odds = np.exp(logs - top[:, None]).sum(1)
                    score[letters] = (1 / odds)[letters]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high],
                        batch.column(2)[low:high],
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(np.round(score, 6), pa.float64()),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )
        shared.trim()

    return docs.select("doc_id", "text", "held_out").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double"
    )
