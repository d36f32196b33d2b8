"""Language-model scores from a small causal self-attention model and corpus counts.

Text is a sequence of words, each a sequence of subword ids of a public vocabulary, and an end.
One attention layer, trained in numpy, sees the ids before a position inside a window and predicts
the class of the next id; within a class, ids have the probabilities of their counts in all
training texts. Windows overlap, so each id is scored once with at least ``OVERLAP`` ids before it
(fewer at a text's start), in batches with one causal mask.

Classes keep ids that begin a word apart from those that go on with one, so the model's
probability of the next word is known. It is mixed with a second one for words seen in training:
the class of the word's first id, as the layer predicts it, times the word's share of the training
tokens that begin with that class. ``MIX`` is the weight of the latter. Both sum to at most one
over all words.

Texts are cut into words and ids once; a worker keeps the ids of a bounded number of words. Each task lays its documents in chunks of bounded size, a
row with its distinct words, their ids and the sequence of its words, and all later passes read
these rows. Counts and the contexts that make the classes cover all training documents. The layer
starts from a fit on at most ``start_windows`` windows, drawn by chunk and position, and then
learns from every window of the training text in one pass: each task streams its chunks and learns
from the same weights as the others, and the layer is a weighted mean of what the tasks learnt. An
id's row weighs by how often a task has it.

Word counts may outgrow any machine. Each chunk's distinct words are summed with all others', and
the counts of those that several chunks have come back to them by a join, so a word travels once
for a chunk and not once for a document, and adaptive execution can split a word that all have.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.words import Words, mix, text_slices, words_of

CHUNK_BYTES = 1 << 24
START_WINDOWS = 60_000
LENGTH = 32
OVERLAP = 8
DIM = 16
START_CLASSES, GO_ON_CLASSES = 27, 36
STEPS, BATCH, RATE = 700, 256, 0.01
PASS_BATCH, PASS_RATE, SLOWER = 256, 0.003, 400
MIX = 0.85
_WORDS = 50_000
_SLOTS, _KEPT_IDS = 1 << 20, 8
_SLICE = 1 << 21
_TOKENS = 300_000
_CONTEXTS = 256


class Subwords:
    """Subword ids of lower-cased words.

    A word that the vocabulary's normaliser leaves nothing of is a blank.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        pieces = [self.model.id_to_piece(i) for i in range(self.size)]
        self.starts = np.array([p.startswith("▁") for p in pieces])
        self.starts[self.end] = True
        self.blank = self.model.piece_to_id("▁")

    def of(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words that lie in ``data``, end to end, and how many each has."""
        ids, counts = [np.zeros(0, np.uint16)], [np.zeros(0, np.int64)]
        for k in range(0, len(starts), _WORDS):
            spans = zip(starts[k : k + _WORDS].tolist(), ends[k : k + _WORDS].tolist())
            found = self.model.encode([data[a:b] for a, b in spans], num_threads=1)
            n = np.fromiter(map(len, found), np.int64, len(found))
            for i in np.flatnonzero(n == 0).tolist():
                found[i], n[i] = (self.blank,), 1
            ids.append(np.fromiter(chain.from_iterable(found), np.uint16, int(n.sum())))
            counts.append(n)
        return np.concatenate(ids), np.concatenate(counts)


class KeptIds:
    """Ids of words met before, each in the slot that its hash gives; the first to come stays.

    Within a chunk and in all counts, too, a word is its 64-bit hash. A word of more than
    ``_KEPT_IDS`` ids is not kept.
    """

    def __init__(self, sub: Subwords, slots: int = _SLOTS):
        self.sub, self.slots = sub, np.uint64(slots)
        self.words, self.n = np.zeros(slots, np.uint64), np.zeros(slots, np.uint8)
        self.ids = np.zeros((slots, _KEPT_IDS), np.uint16)

    def of(
        self, words: np.ndarray, data: bytes, starts: np.ndarray, ends: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """As ``Subwords.of``, for distinct words with these hashes, the more frequent first."""
        slot = (words % self.slots).astype(np.int64)
        n = self.n[slot]
        met = (n > 0) & (self.words[slot] == words)
        new = np.flatnonzero(~met)
        ids, counts = self.sub.of(data, starts[new], ends[new])
        each = n.astype(np.int64)
        each[new] = counts
        out = np.empty(int(each.sum()), np.uint16)
        cut = np.repeat(~met, each)
        out[cut] = ids
        out[~cut] = self.ids[slot[met]][np.arange(_KEPT_IDS) < n[met, None]]
        able = np.flatnonzero((n[new] == 0) & (counts <= _KEPT_IDS))
        free, first = np.unique(slot[new[able]], return_index=True)
        able = able[first]
        rows = np.zeros((len(able), _KEPT_IDS), np.uint16)
        rows[np.arange(_KEPT_IDS) < counts[able, None]] = ids[
            _spread((np.cumsum(counts) - counts)[able], counts[able])
        ]
        self.words[free], self.n[free], self.ids[free] = words[new[able]], counts[able], rows
        return out, each


_subwords: dict[str, Subwords] = {}


def subwords(path: str) -> Subwords:
    if path not in _subwords:
        _subwords[path] = Subwords(path)
    return _subwords[path]


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at ``starts`` and have ``counts`` items, end to end."""
    at = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    at += np.arange(len(at))
    return at


def _runs(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``_spread`` where no run is empty: a sum of steps, faster than repeating."""
    if not len(counts):
        return np.zeros(0, np.int32)
    ends = np.cumsum(counts)
    steps = np.ones(int(ends[-1]), np.int32)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - (starts[:-1] + counts[:-1] - 1)
    return np.cumsum(steps, out=steps)


def _times(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The last axis times a matrix, in one product and not one for each window."""
    return (rows.reshape(-1, len(weights)) @ weights).reshape(*rows.shape[:-1], -1)


class Attention:
    """One causal self-attention layer over subword ids that predicts classes."""

    NAMES = ("embed", "place", "match", "move", "out", "bias")

    def __init__(self, classes: np.ndarray, n_ids: int, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        n = int(classes.max()) + 1

        def near_zero(*shape: int, scale: float = 0.1) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.classes = classes
        self.embed, self.place = near_zero(n_ids, DIM, scale=0.3), near_zero(LENGTH, DIM)
        self.match, self.move = near_zero(DIM, DIM), near_zero(DIM, DIM)
        self.out, self.bias = near_zero(DIM, n), np.zeros(n, np.float32)

    def _layer(self, ids: np.ndarray, first: int = 0):
        """The layer at each position from ``first`` on. Scores are kept small, so none overflows;
        weights of what is seen are not divided by their ``total``."""
        x = np.take(self.embed, ids, axis=0)
        x += self.place[: ids.shape[1]]
        asked = _times(x[:, first:], self.match)
        p = asked @ x.transpose(0, 2, 1)
        np.clip(p, -30, 30, out=p)
        np.exp(p, out=p)
        p *= np.tri(ids.shape[1], dtype=np.float32)[first:]
        total = p @ np.ones((ids.shape[1], 1), np.float32)
        seen = p @ x
        seen /= total
        y = _times(seen, self.move)
        y += x[:, first:]
        return x, asked, p, total, seen, y

    def log_scores(
        self, ids: np.ndarray, target: np.ndarray, groups: np.ndarray, first: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """At each position from ``first`` on: log probability of the class of ``target``, and of
        the classes that ``groups`` marks."""
        e = _times(self._layer(ids, first)[-1], self.out).reshape(-1, len(self.bias))
        np.clip(e, -30, 30, out=e)
        classes = np.take(self.classes, target[:, first:].ravel())
        own = np.take(e, np.arange(0, e.size, e.shape[1]) + classes)
        own += np.take(self.bias, classes)
        np.exp(e, out=e)
        by_class = np.exp(self.bias)
        sums = np.log(e @ np.stack((by_class, by_class * groups), 1))
        return own - sums[:, 0], sums[:, 1] - sums[:, 0]

    def _gradients(
        self, ids: np.ndarray, target: np.ndarray
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients, and the ids whose rows that of ``embed`` has: those of the batch.

        What is a factor of a class or of a position stays out of the large array of both.
        """
        x, asked, p, total, seen, y = self._layer(ids)
        rows, target = y.reshape(-1, DIM), target.ravel()
        n = len(rows)
        e = rows @ self.out
        np.clip(e, -30, 30, out=e)
        np.exp(e, out=e)
        by_class = np.exp(self.bias)
        by = e @ by_class
        e.ravel()[np.arange(0, e.size, e.shape[1]) + target] -= by / np.take(by_class, target)
        by *= n
        np.divide(1, by, out=by)
        dy = (e @ (self.out * by_class).T).reshape(y.shape)
        dy *= by.reshape(*y.shape[:2], 1)
        rows *= by[:, None]
        g = {"bias": by @ e * by_class, "out": (e.T @ rows).T * by_class}
        g["move"] = seen.reshape(-1, DIM).T @ dy.reshape(-1, DIM)
        dseen = _times(dy, self.move.T)
        dseen /= total
        dp = dseen @ x.transpose(0, 2, 1)
        dp -= np.einsum("bik,bik->bi", dseen, seen)[:, :, None]
        dp *= p
        dasked = dp @ x
        g["match"] = x.reshape(-1, DIM).T @ dasked.reshape(-1, DIM)
        dx = dy
        dx += p.transpose(0, 2, 1) @ dseen
        dx += dp.transpose(0, 2, 1) @ asked
        dx += _times(dasked, self.match.T)
        g["place"] = dx.sum(0)
        flat = ids.ravel().astype(np.uint16)
        order = np.argsort(flat, kind="stable")
        flat = np.take(flat, order)
        first = np.flatnonzero(np.diff(flat, prepend=flat[0] + 1))
        g["embed"] = np.add.reduceat(np.take(dx.reshape(-1, DIM), order, axis=0), first, axis=0)
        return g, np.take(flat, first)

    def _adam(self, batches: Iterator[tuple[np.ndarray, float]]) -> None:
        """Adam; of ``embed``, a step moves the rows of its batch alone."""
        mean = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        square = {n: np.zeros_like(getattr(self, n)) for n in self.NAMES}
        for step, (pick, rate) in enumerate(batches, 1):
            grads, touched = self._gradients(pick[:, :-1], self.classes[pick[:, 1:]])
            for n in self.NAMES:
                at = touched if n == "embed" else slice(None)
                m, v, g = mean[n][at], square[n][at], grads[n]
                m += 0.1 * (g - m)
                g *= g
                g -= v
                g *= 0.01
                v += g
                if n == "embed":
                    mean[n][at], square[n][at] = m, v
                by = np.sqrt(v, out=g)
                by *= (1 - 0.99**step) ** -0.5
                by += 1e-6
                np.divide(m, by, out=by)
                by *= rate / (1 - 0.9**step)
                getattr(self, n)[at] -= by

    def fit(self, windows: np.ndarray, seed: int = 2) -> None:
        """Adam on windows of ``LENGTH + 1`` ids."""
        rng = np.random.Generator(np.random.PCG64(seed))
        self._adam(
            (
                windows[rng.integers(0, len(windows), BATCH)],
                RATE * min(1.0, 2.0 * (1 - step / (STEPS + 1))),
            )
            for step in range(1, STEPS + 1)
        )

    def learn(self, parts: Iterator[np.ndarray]) -> None:
        """Adam once over all windows of ``parts``."""
        batches = (w[k : k + PASS_BATCH] for w in parts for k in range(0, len(w), PASS_BATCH))
        self._adam((w, PASS_RATE / (1 + k / SLOWER) ** 0.5) for k, w in enumerate(batches))

    def rows(self) -> np.ndarray:
        """All weights in rows of ``DIM``, those of the ids first."""
        bias = np.zeros(-(-len(self.bias) // DIM) * DIM, np.float32)
        bias[: len(self.bias)] = self.bias
        parts = (self.embed, self.place, self.match, self.move, self.out.T, bias.reshape(-1, DIM))
        return np.concatenate(parts)

    def set_rows(self, rows: np.ndarray) -> None:
        n = len(self.bias)
        sizes = np.cumsum([len(self.embed), LENGTH, DIM, DIM, n])
        self.embed, self.place, self.match, self.move, out, bias = np.split(
            rows.astype(np.float32), sizes
        )
        self.out, self.bias = np.ascontiguousarray(out.T), bias.ravel()[:n]


def _kmeans(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(8):
        nearest = (points @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (mine := points[nearest == c]).size:
                centre = mine.sum(0)
                centres[c] = centre / max(float(np.linalg.norm(centre)), 1e-9)
    return (points @ centres.T).argmax(1)


def id_classes(
    around: np.ndarray, counts: np.ndarray, starts: np.ndarray, end: int
) -> np.ndarray:
    """A class for each id: by the ids around it where it is frequent in the training text.

    ``around`` has how often each common id comes before and after it. Class 0 is the end of a
    text; word-initial ids have the classes up to ``START_CLASSES``.
    """
    rng = np.random.Generator(np.random.PCG64(4))
    n = len(starts)
    around = np.sqrt(around)
    around /= np.maximum(np.linalg.norm(around, axis=1, keepdims=True), np.float32(1e-9))
    classes = np.zeros(n, np.int64)
    base = 1
    for side, k in ((starts, START_CLASSES), (~starts, GO_ON_CLASSES)):
        often = np.flatnonzero(side & (counts >= 5))
        classes[side] = base + k - 1
        if len(often):
            classes[often] = base + _kmeans(around[often], k - 1, rng)
        base += k
    classes[end] = 0
    return classes


def _within(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log probability of each id within its class, from corpus counts."""
    smooth = counts + 0.5
    return np.log(smooth / np.bincount(classes, smooth)[classes]).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _columns(counts: np.ndarray) -> np.ndarray:
    """The context column of each id: one for each common id and one for all others."""
    columns = np.full(len(counts), _CONTEXTS)
    common = np.argsort(-counts, kind="stable")[:_CONTEXTS]
    columns[common] = np.arange(len(common))
    return columns


def _windows(sequence: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Windows that cover sequences laid end to end.

    Each next id is predicted once. The ends of sequences that fill no window are put end to end;
    the last of them goes over to ids that were there before.
    """
    first = np.cumsum(lengths) - lengths
    full = (lengths - 1) // LENGTH
    at = np.repeat(first, full) + _spread(np.zeros(len(full), np.int64), full) * LENGTH
    whole = np.zeros((0, LENGTH + 1), sequence.dtype)
    if len(at):
        whole = np.lib.stride_tricks.sliding_window_view(sequence, LENGTH + 1)[at]
    left = lengths - full * LENGTH
    left[left == 1] = 0
    rest = _spread(first + full * LENGTH, left)
    if not len(rest):
        return whole
    k = max(1, -(-(len(rest) - 1) // LENGTH))
    begin = np.minimum(np.arange(k) * LENGTH, max(0, len(rest) - LENGTH - 1))
    of = (begin[:, None] + np.arange(LENGTH + 1)) % len(rest)
    return np.concatenate((whole, sequence[rest[of]]))


_CHUNK = (
    "chunk long, doc_id array<long>, held_out array<boolean>, n_words array<long>, "
    "words array<long>, n array<long>, each binary, ids binary, tokens binary"
)


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: pa.BinaryScalar, n: int, kind: type) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data.as_buffer(), size, codec="zstd"), kind)


def _chunk_row(slices: list[tuple], number: int, kept: KeptIds) -> pa.RecordBatch:
    """A row of a chunk made of slices; its words are in the order of their frequency."""
    doc_id, out, n_words, distinct, n, data, first, last, tokens = zip(*slices)
    start = np.cumsum([0, *map(len, distinct)])
    base = np.repeat(np.cumsum([0, *map(len, data)])[:-1], np.diff(start))
    words, at, to = np.unique(np.concatenate(distinct), return_index=True, return_inverse=True)
    tokens = np.concatenate([to[s + t] for s, t in zip(start, tokens)])
    order = np.argsort(-np.bincount(tokens, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words))
    trained = np.bincount(to, np.concatenate(n), len(words)).astype(np.int64)[order]
    words, at = words[order], at[order]
    first, last = ((base + np.concatenate(edge))[at] for edge in (first, last))
    ids, each = kept.of(words, b"".join(data), first, last)

    def listed(values) -> pa.Array:
        return pa.array([values])

    columns = [
        pa.array([number], pa.int64()),
        pa.ListArray.from_arrays([0, sum(map(len, doc_id))], pa.concat_arrays(doc_id)),
        listed(np.concatenate(out)),
        listed(np.concatenate(n_words)),
        pa.array([words.view(np.int64)], pa.list_(pa.int64())),
        pa.array([trained], pa.list_(pa.int64())),
        pa.array([_packed(each.astype(np.uint32))], pa.binary()),
        pa.array([_packed(ids)], pa.binary()),
        pa.array([_packed(rank[tokens])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CHUNK.split(", ")])


def _encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` (doc_id, held_out, text) in rows of chunks, see ``_CHUNK``.

    ``n`` is how often a word is in the chunk's training documents. A chunk is numbered by its
    task and its place in it; it is written once, and all that follows reads what was written.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.only("lm encoding")
        if path not in held:
            held[path] = KeptIds(subwords(path))
        kept = held[path]
        number = TaskContext.get().partitionId() << 32
        slices, size = [], 0
        for batch in batches:
            out = batch.column("held_out").to_numpy(zero_copy_only=False)
            for low, high, data, offsets in text_slices(batch.column("text"), _SLICE):
                found = words_of(data, offsets)
                distinct, first, inverse = np.unique(
                    found.hashes, return_index=True, return_inverse=True
                )
                n = np.bincount(inverse, ~out[low:high][found.doc], len(distinct))
                slices.append(
                    (
                        batch.column("doc_id")[low:high], out[low:high], found.per_doc(),
                        distinct, n, found.data.tobytes(), found.starts[first], found.ends[first],
                        inverse.astype(np.uint32),
                    )
                )
                size += len(data)
                if size >= CHUNK_BYTES:
                    yield _chunk_row(slices, number, kept)
                    number, slices, size = number + 1, [], 0
        if slices:
            yield _chunk_row(slices, number, kept)
        shared.trim()

    made = docs.select("doc_id", "held_out", "text").mapInArrow(encode, _CHUNK)
    return shared.stored(made, "encoded")


class Chunk:
    """A row of a chunk, read back."""

    def __init__(self, table: pa.Table | pa.RecordBatch, row: int):
        def values(name: str) -> np.ndarray:
            return table[name][row].values.to_numpy(zero_copy_only=False)

        self.number = np.uint64(table["chunk"][row].as_py())
        self.held_out, self.n_words, n = values("held_out"), values("n_words"), values("n")
        self.trained = n
        self.each = _unpacked(table["each"][row], len(n), np.uint32).astype(np.int64)
        self.starts = np.cumsum(self.each) - self.each
        self.ids = _unpacked(table["ids"][row], int(self.each.sum()), np.uint16)
        self.tokens = _unpacked(table["tokens"][row], int(self.n_words.sum()), np.uint32)

    def parts(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first document, end, words) of runs of documents of bounded size, or of one."""
        ends, low = np.cumsum(self.n_words), 0
        while low < len(ends):
            done = int(ends[low - 1]) if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + _TOKENS, "right")))
            yield low, high, self.tokens[done : ends[high - 1]].astype(np.int64)
            low = high

    def windows(self, sub: Subwords) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(windows, sequence, its documents' lengths) of runs of training documents, each
        document from its begin to its end."""
        for low, high, tokens in self.parts():
            train, n_words = ~self.held_out[low:high], self.n_words[low:high]
            if not train.any():
                continue
            tokens, n_words = tokens[np.repeat(train, n_words)], n_words[train]
            each = self.each[tokens]
            lengths = 2 + np.bincount(
                np.repeat(np.arange(len(n_words)), n_words), each, len(n_words)
            ).astype(np.int64)
            first = np.cumsum(lengths) - lengths
            sequence = np.empty(int(lengths.sum()), np.uint16)
            inner = np.ones(len(sequence), bool)
            inner[first] = inner[first + lengths - 1] = False
            sequence[inner] = np.take(self.ids, _runs(self.starts[tokens], each))
            sequence[first], sequence[first + lengths - 1] = sub.begin, sub.end
            yield _windows(sequence, lengths), sequence, lengths

    def picks(self, part: int, n: int) -> np.ndarray:
        """Numbers below 2**63 that draw windows, and put those of a part in order."""
        begin = mix(np.array([self.number, part], np.uint64)).sum()
        return mix(begin + np.arange(n, dtype=np.uint64)) >> np.uint64(1)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    shared.only("lm")
    for batch in batches:
        for row in range(batch.num_rows):
            yield Chunk(batch, row)


_READ = ("chunk", "held_out", "n_words", "n", "each", "ids", "tokens")


def _id_counts(encoded: DataFrame, sub: Subwords) -> np.ndarray:
    """How often each id is in the words of the training text."""
    n_ids = sub.size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_ids, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                n = batch["n"][row].values.to_numpy()
                each = _unpacked(batch["each"][row], len(n), np.uint32)
                ids = _unpacked(batch["ids"][row], int(each.sum()), np.uint16)
                total += np.bincount(ids, np.repeat(n, each), n_ids).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    seen = encoded.select("n", "each", "ids").mapInArrow(count, "id long, n long")
    seen = seen.groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_ids)
    out[seen["id"].to_numpy()] = seen["n"].to_numpy()
    return out


def _surveyed(encoded: DataFrame, path: str, columns: np.ndarray, rate: float) -> DataFrame:
    """How often ids have each context (cell, n), and the windows drawn at ``rate`` (pick, ids)."""
    wide, limit = _CONTEXTS + 1, np.uint64(int(min(rate, 1.0) * (2**63 - 1)))

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(path)
        around = np.zeros(2 * sub.size * wide, np.int32)
        for chunk in _chunks(batches):
            for part, (windows, sequence, lengths) in enumerate(chunk.windows(sub)):
                inside = np.ones(len(sequence) - 1, bool)
                inside[np.cumsum(lengths)[:-1] - 1] = False
                pairs = (s[inside].astype(np.int64) for s in (sequence[:-1], sequence[1:]))
                before, after = pairs
                for side, (a, b) in enumerate(((before, after), (after, before))):
                    np.add.at(around, (side * sub.size + a) * wide + columns[b], np.int32(1))
                picks = chunk.picks(part, len(windows))
                drawn = picks <= limit
                n, raw = int(drawn.sum()), windows[drawn]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                        pa.array(picks[drawn].astype(np.int64)),
                        pa.array([w.tobytes() for w in raw], pa.binary()),
                    ],
                    ["cell", "n", "pick", "ids"],
                )
        cells = np.flatnonzero(around)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cells), pa.array(around[cells].astype(np.int64)),
                pa.nulls(len(cells), pa.int64()), pa.nulls(len(cells), pa.binary()),
            ],
            ["cell", "n", "pick", "ids"],
        )
        del around
        shared.trim()

    made = encoded.select(*_READ).mapInArrow(survey, "cell long, n long, pick long, ids binary")
    return shared.stored(made, "survey")


def _learn(encoded: DataFrame, path: str, net: Attention) -> int:
    """Learn from all windows, each task from those of its chunks; returns how many they are."""
    sent = encoded.sparkSession.sparkContext.broadcast(net)
    values = [f"v{k}" for k in range(DIM)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sub = subwords(path)
        mine = Attention.__new__(Attention)
        mine.__dict__.update({k: v.copy() for k, v in sent.value.__dict__.items()})
        often = np.zeros(len(mine.embed))
        n = 0

        def parts() -> Iterator[np.ndarray]:
            nonlocal n
            for chunk in _chunks(batches):
                for part, (windows, *_) in enumerate(chunk.windows(sub)):
                    windows = windows[np.argsort(chunk.picks(part, len(windows)))]
                    often[:] += np.bincount(windows[:, :-1].ravel(), minlength=len(often))
                    n += len(windows)
                    yield windows

        mine.learn(parts())
        rows = mine.rows()
        weight = np.full(len(rows), float(n))
        weight[: len(often)] = often
        some = np.flatnonzero(weight)
        sums = rows[some] * weight[some, None]
        counted = np.zeros(len(some), np.int64)
        counted[:1] = n
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (some, weight[some], counted, *sums.T.copy())],
            ["row", "w", "windows", *values],
        )
        shared.trim()

    kinds = ", ".join(["row long, w double, windows long", *(f"{v} double" for v in values)])
    learnt = (
        encoded.select(*_READ)
        .mapInArrow(learn, kinds)
        .groupBy("row")
        .agg(*(F.sum(c).alias(c) for c in ("w", "windows", *values)))
        .toArrow()
    )
    sent.destroy()
    if not learnt.num_rows:
        return 0
    rows = net.rows()
    sums = np.stack([learnt[v].to_numpy() for v in values], 1)
    rows[learnt["row"].to_numpy()] = sums / learnt["w"].to_numpy()[:, None]
    net.set_rows(rows)
    return int(learnt["windows"].to_numpy().sum())


def _fitted(
    encoded: DataFrame, path: str, id_counts: np.ndarray, sub: Subwords, start_windows: int
) -> Attention:
    """The layer, its classes and weights made from all training text."""
    counts = id_counts.copy()
    counts[sub.begin] += id_counts[sub.end]
    n_windows = max(1, int(counts.sum()) // LENGTH)
    survey = _surveyed(encoded, path, _columns(counts), 1.2 * start_windows / n_windows)
    cells = survey.filter("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(2 * sub.size * (_CONTEXTS + 1), np.float32)
    flat[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    around = np.concatenate(flat.reshape(2, sub.size, _CONTEXTS + 1), axis=1)
    net = Attention(id_classes(around, counts, sub.starts, sub.end), sub.size)
    drawn = survey.filter("pick is not null").select("pick", "ids")
    sample = drawn.orderBy("pick", "ids").limit(start_windows).toArrow()
    if sample.num_rows:
        ids = np.frombuffer(b"".join(sample["ids"].to_pylist()), np.uint16)
        net.fit(ids.astype(np.int64).reshape(-1, LENGTH + 1))
        _learn(encoded, path, net)
    return net


def _id_scores(model, sub: Subwords, ids: np.ndarray, lengths: np.ndarray):
    """For sequences laid end to end, each ending in the end id: by position, the log
    probability of its id's class and that of a word beginning there."""
    net, starting = model
    log_class = np.empty(len(ids), np.float32)
    log_start = np.empty(len(ids), np.float32)
    first = np.cumsum(lengths) - lengths
    inputs = np.empty_like(ids)
    inputs[1:] = ids[:-1]
    inputs[first] = sub.begin
    step = LENGTH - OVERLAP
    # A sequence's first window scores LENGTH positions, each further one the last ``step``.
    more = np.maximum(0, -(-(lengths - LENGTH) // step))
    begin = np.concatenate((first, _spread(np.zeros(len(first), np.int64), more) * step))
    begin[len(first) :] += np.repeat(first, more) + step
    stop = np.concatenate((first + lengths, np.repeat(first + lengths, more)))
    skip = np.zeros(len(begin), np.int64)
    skip[len(first) :] = OVERLAP
    for low_skip in (0, OVERLAP):
        of = np.flatnonzero(skip == low_skip)
        for k in range(0, len(of), 128):
            w = of[k : k + 128]
            at = begin[w][:, None] + np.arange(LENGTH)
            inside = at < stop[w][:, None]
            np.minimum(at, len(ids) - 1, out=at)
            own, begins = net.log_scores(inputs[at], ids[at], starting, low_skip)
            use = inside[:, low_skip:].ravel()
            to = at[:, low_skip:].ravel()[use]
            log_class[to], log_start[to] = own[use], begins[use]
    return log_class, log_start


def _score(path: str, model, n_docs: int):
    """Scores of a chunk's documents, given the counts of its words."""

    def score(chunks: pa.Table, words: pa.Table) -> pa.Table:
        shared.only("lm")
        sub, (net, within, class_counts) = subwords(path), model.value
        starting = np.zeros(int(net.classes.max()) + 1, np.float32)
        starting[: START_CLASSES + 1] = 1.0
        chunk = Chunk(chunks, 0)
        # Words that came back are in other chunks too; of the others the chunk has all.
        count = chunk.trained.copy()
        mine = count > 0
        count[words["at"].to_numpy()] = words["c"].to_numpy()
        mine[words["at"].to_numpy()] = words["mine"].to_numpy(zero_copy_only=False)
        log_count = np.log10(count + 1.0)

        def log_share(counts, first_ids):
            of_class = np.maximum(class_counts[net.classes[first_ids]], 1)
            return np.log(np.maximum(counts / of_class, 1e-300))

        word_share = log_share(count, chunk.ids[chunk.starts])
        end_share = log_share(n_docs, sub.end)
        columns: list[list[np.ndarray]] = [[] for _ in range(4)]
        for low, high, tokens in chunk.parts():
            n = high - low
            # Words of each document, then its end, whose count is the number of documents.
            per_doc = chunk.n_words[low:high]
            doc_of = np.repeat(np.arange(n), per_doc)
            place = np.arange(len(tokens)) + doc_of
            ends = np.cumsum(per_doc + 1) - 1
            sizes = np.ones(len(place) + n, np.int64)
            sizes[place] = chunk.each[tokens]
            sequence = np.empty(int(sizes.sum()), np.uint16)
            token_at = np.cumsum(sizes) - sizes
            inner = np.ones(len(sequence), bool)
            inner[token_at[ends]] = False
            sequence[inner] = np.take(chunk.ids, _runs(chunk.starts[tokens], sizes[place]))
            sequence[token_at[ends]] = sub.end
            doc = np.repeat(np.arange(n), per_doc + 1)
            lengths = np.bincount(doc, sizes, n).astype(np.int64)
            log_class, log_start = _id_scores((net, starting), sub, sequence, lengths)
            log_id = log_class.astype(np.float64) + within[sequence]
            # A word's own probability: its ids, given that one begins, and that one begins after.
            begins = log_start[token_at]
            own = np.add.reduceat(log_id, token_at) - begins
            after = np.zeros(len(own))
            after[place] = log_start[token_at[place + 1]]
            share = np.full(len(own), end_share)
            share[place] = word_share[tokens]
            own += after + np.log(1 - MIX)
            seen = log_class[token_at] - begins + share + np.log(MIX)
            mixed = np.maximum(own, seen) + np.log1p(np.exp(-np.abs(own - seen)))
            columns[0].append(per_doc + 1)
            known = np.bincount(doc_of, count[tokens] > 0, n).astype(np.int64)
            columns[1].append(known + (n_docs > 0))
            base = np.bincount(doc_of, log_count[tokens], n) + np.log10(n_docs + 1.0)
            columns[2].append(base)
            columns[3].append(np.bincount(doc, mixed, n) / np.log(10))
        n_tokens, n_known, base, total = map(np.concatenate, columns)
        # Words that this chunk counts for the vocabulary.
        distinct = np.zeros(len(n_tokens), np.int64)
        distinct[0] = int(mine.sum())
        ids = chunks["doc_id"][0].values
        shared.trim()
        return pa.table(
            [ids, chunk.held_out, n_tokens, n_known, base, total, distinct], schema=_SCORED
        )

    return score


_SCORED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
        ("distinct", pa.int64()),
    ]
)


def score_texts(
    docs: DataFrame, vocabulary_path: str, start_windows: int = START_WINDOWS
) -> DataFrame:
    """Scores of every row of ``docs`` (doc_id, text).

    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, where ``base_score``
    is the add-one unigram score of words and end, ``score`` the model's, both log10. Documents
    with crc32(doc_id as text) of 2 modulo 7 are held out, the rest is trained on; a row without
    doc_id is trained on. A null or empty text is an end alone. Rows that repeat count each. With
    no training rows, ``train_tokens`` is 0 and the layer keeps its first weights. Other columns
    are not looked at. The layer learns from all training text, after a first fit on at most
    ``start_windows`` windows of it.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    shared.small_batches(spark)
    docs = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
    )
    encoded = _encoded(docs, vocabulary_path)
    rows = encoded.select(F.explode(F.arrays_zip("held_out", "n_words")).alias("of"))
    n_docs, n_words = (
        rows.filter("not of.held_out")
        .agg(F.count(F.lit(1)), F.coalesce(F.sum("of.n_words"), F.lit(0)))
        .first()
    )
    n_train = n_words + n_docs
    sub = subwords(vocabulary_path)
    id_counts = _id_counts(encoded, sub)
    id_counts[sub.end] = n_docs

    net = _fitted(encoded, vocabulary_path, id_counts, sub, start_windows)
    classes = net.classes
    # Words begin with one word-initial id each, so these count the words of a class.
    class_counts = np.bincount(classes, id_counts)
    model = spark.sparkContext.broadcast((net, _within(classes, id_counts), class_counts))

    own = encoded.select(F.col("chunk").alias("to"), "n", F.posexplode("words").alias("at", "word"))
    own = own.withColumn("n", F.get("n", "at"))
    # A chunk has the counts of words that no other has; these need not come back.
    sums = (
        own.groupBy("word")
        .agg(F.sum("n").alias("c"), F.min("to").alias("owner"), F.max("to").alias("last"))
        .filter("c > 0 and owner < last")
    )
    returned = own.drop("n").join(sums, "word").select(
        "to", "at", "c", (F.col("owner") == F.col("to")).alias("mine")
    )
    scored = shared.stored(
        encoded.select("chunk", "doc_id", *_READ[1:])
        .groupBy("chunk")
        .cogroup(returned.groupBy("to"))
        .applyInArrow(
            _score(vocabulary_path, model, n_docs),
            "doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
            "score double, distinct long",
        ),
        "scored",
    )
    n_distinct = scored.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0] + (n_docs > 0)
    every = F.log10(F.lit(float(n_train + n_distinct + 1)))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * every).alias("base_score"),
        "score",
    )
