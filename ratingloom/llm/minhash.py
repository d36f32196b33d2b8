"""Near-duplicate documents by b-bit MinHash, exact on the pairs it considers.

A document's set is its distinct runs of ``words`` words. From ``HASHES`` minima per set only the
low ``BITS`` bits are kept, packed into longs. Full minima make ``BANDS`` band keys before they are
thrown away; two sets of similarity s share a band with probability 1 - (1 - s**4)**32, which is
0.999995 at 0.75. Candidates are pairs in a band. Their similarity is estimated from the packed
signatures by bit counts, corrected for the 1 in 2**BITS chance of equal low bits, and pairs that
come within ``MARGIN`` of the threshold (over five standard errors) are decided on the full sets.

Equal sets are one node from the start. In a band's bucket all nodes are first compared with the
smallest one, the hub. Nodes that the hub's component takes in need no further comparison with
each other, so a bucket of n copies costs n comparisons. The nodes left outside are compared with
all nodes of other components in their buckets: pair by pair where they are few, else in blocks of
full sets that emit links only. No pair of two components that share a bucket goes unseen.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.graph import components
from ratingloom.llm.words import mix, text_slices, words_of

HASHES = 128
BANDS = 32
BITS = 4
MARGIN = 0.2
#: Up to so many outsiders of a component are compared pair by pair, more in blocks of nodes.
FEW = 16
BLOCK = 128

_PER_LONG = 64 // BITS
_LONGS = HASHES // _PER_LONG
_RANDOM = np.random.Generator(np.random.PCG64(5))
_MULTIPLY = _RANDOM.integers(0, 2**32, HASHES, np.uint32) | np.uint32(1)
_ADD = _RANDOM.integers(0, 2**32, HASHES, np.uint32)
_BAND = _RANDOM.integers(0, 2**64, (HASHES // BANDS, BANDS), np.uint64) | np.uint64(1)
_CHUNK = 2048


def _minima(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Minima of all hash functions for each non-empty slice of ``sets`` between ``bounds``."""
    out = np.full((len(bounds) - 1, HASHES), 2**32 - 1, np.uint32)
    short = (sets >> np.uint64(32)).astype(np.uint32)
    for low in range(0, len(short), _CHUNK):
        high = min(low + _CHUNK, len(short))
        hashed = short[low:high, None] * _MULTIPLY + _ADD
        first = int(np.searchsorted(bounds, low, "right")) - 1
        last = int(np.searchsorted(bounds, high, "left"))
        cuts = np.maximum(bounds[first:last], low) - low
        np.minimum(out[first:last], np.minimum.reduceat(hashed, cuts, axis=0), out=out[first:last])
    return out


def _distinct(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, concatenated, and where each text begins."""
    order = np.lexsort((hashes, doc)) if n > 1 else np.argsort(hashes)
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return hashes[new], np.concatenate(([0], np.cumsum(np.bincount(doc[new], minlength=n))))


def _sets(batches: Iterator[pa.RecordBatch], words: int):
    shared.only("minhash")
    for batch in batches:
        ids = batch.column(0)
        for low, high, data, offsets in text_slices(batch.column(1)):
            found = words_of(data, offsets)
            yield ids[low:high], *_distinct(*found.shingles(words), high - low)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    flat = pa.array(values.ravel(), kind)
    return pa.FixedSizeListArray.from_arrays(flat, values.shape[1]).cast(pa.list_(kind))


def signatures(docs: DataFrame, words: int = 5) -> DataFrame:
    """One row per document: set size, 128-bit hash of the set, packed signature, band keys.

    A null or wordless text has size 0 and no signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets, bounds in _sets(batches, words):
            n = len(ids)
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes)
            packed, bands = np.zeros((n, _LONGS), np.uint64), np.zeros((n, BANDS), np.uint64)
            digest = np.zeros((2, n), np.uint64)
            if len(full):
                minima = _minima(sets, np.append(bounds[:-1][full], bounds[-1]))
                # The lowest bits of a product mix too little; the next ones do.
                low = ((minima >> np.uint32(8)) & np.uint32(2**BITS - 1)).astype(np.uint64)
                shift = np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS)
                packed[full] = (low.reshape(len(full), _LONGS, _PER_LONG) << shift).sum(
                    2, dtype=np.uint64
                )
                rows = minima.reshape(len(full), HASHES // BANDS, BANDS).astype(np.uint64)
                bands[full] = mix((mix(rows + np.uint64(1)) * _BAND).sum(1, dtype=np.uint64))
                for i, salt in enumerate((0, 0x5851F42D4C957F2D)):
                    spread = mix(sets ^ np.uint64(salt))
                    digest[i, full] = np.add.reduceat(spread, bounds[:-1][full])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(sizes, pa.int64()),
                    pa.array(digest[0].view(np.int64)),
                    pa.array(digest[1].view(np.int64)),
                    _lists(packed.view(np.int64), pa.int64()),
                    _lists(bands.view(np.int64), pa.int64()),
                ],
                ["doc_id", "n_shingles", "set_a", "set_b", "sig", "bands"],
            )
        shared.trim()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        sign,
        "doc_id long, n_shingles long, set_a long, set_b long, sig array<long>, bands array<long>",
    )


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures, corrected for accidental matches."""
    ones = sum(1 << (BITS * i) for i in range(_PER_LONG))
    ones = ones - (1 << 64) if ones >> 63 else ones
    differ = F.lit(0)
    for i in range(_LONGS):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        for k in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, k))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(ones)))
    chance = 2.0**-BITS
    return (1 - differ / F.lit(float(HASHES)) - chance) / (1 - chance)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    joined = pairs
    for end in ("a", "b"):
        side = sets.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}"))
        joined = joined.join(side, end)
    shared_size = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared_size
    return joined.filter(100 * shared_size >= percent * union).select("a", "b")


def _candidates(hubs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs of a bucket's hubs and members, of two components, that may be similar."""
    near = estimate("hub_sig", "sig") >= percent / 100 - MARGIN
    return (
        members.join(hubs, "key")
        .filter(near & (F.col("hub_component") != F.col("component")))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``wanted`` and of a few others.

    A bit map spares most texts the hashing and all the shuffle; the joins that follow are exact.
    """
    bits = shared.bit_filter(wanted, F.xxhash64("node"))

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = np.flatnonzero(shared.may_hold(bits, batch.column(2).to_numpy()))
            for ids, sets, bounds in _sets([batch.take(pa.array(use))], words):
                shingles = pa.ListArray.from_arrays(
                    pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64))
                )
                yield pa.RecordBatch.from_arrays([ids, shingles], ["node", "shingles"])
        shared.trim()

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string"))
    found = texts.filter("node is not null").withColumn("hashed", F.xxhash64("node"))
    return found.mapInArrow(collect, "node long, shingles array<long>")


def _members_with(members: DataFrame, labels: DataFrame) -> DataFrame:
    joined = members.drop("component").join(labels, "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set on the left, the sizes of its intersections with all on the right."""
    values = np.concatenate(right)
    owners = np.repeat(np.arange(len(right)), [len(r) for r in right])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    for one in left:
        low, high = np.searchsorted(values, one, "left"), np.searchsorted(values, one, "right")
        n = high - low
        at = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        yield np.bincount(owners[at], minlength=len(right))


def _compare_blocks(percent: int):
    """Links between the components of two blocks of full sets, one for each pair of components."""

    def compare(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        node, component = table["node"].to_numpy(), table["component"].to_numpy()
        out = table["outside"].to_numpy()
        sets = [np.asarray(x.values) for x in table["shingles"]]
        sizes = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(out), np.flatnonzero(~out if kind == 0 else out)
        links: dict[tuple[int, int], tuple[int, int]] = {}
        if len(left) and len(right):
            near = _intersections([sets[i] for i in left], [sets[i] for i in right])
            for i, both in zip(left, near):
                union = sizes[i] + sizes[right] - both
                for j in right[100 * both >= percent * union]:
                    if component[i] != component[j]:
                        ends = tuple(sorted((int(component[i]), int(component[j]))))
                        links.setdefault(ends, tuple(sorted((int(node[i]), int(node[j])))))
        ends = list(zip(*links.values())) or [(), ()]
        return pa.table({"a": pa.array(ends[0], pa.int64()), "b": pa.array(ends[1], pa.int64())})

    return compare


def _blocks(outside: DataFrame, inside: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the outsiders of a bucket's main component and its members or each other.

    Both sides are dealt in blocks of about ``BLOCK`` nodes, and pairs of blocks are compared on
    full sets where they meet. What leaves a comparison are links only, not pairs.
    """
    counts = (
        outside.groupBy("main")
        .agg(F.count(F.lit(1)).alias("n_out"))
        .join(inside.groupBy("main").agg(F.count(F.lit(1)).alias("n_in")), "main")
        .select(
            "main",
            F.ceil(F.col("n_out") / BLOCK).alias("p"),
            F.ceil(F.col("n_in") / BLOCK).alias("q"),
        )
    )
    spread = F.xxhash64(F.lit(7), "node")
    out = outside.join(counts, "main").withColumn("i", F.pmod(spread, F.col("p")))
    ins = inside.join(counts, "main").withColumn("i", F.pmod(spread, F.col("q")))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).alias("j")

    base = ["main", "node", "component"]
    yes, no = F.lit(True).alias("outside"), F.lit(False).alias("outside")
    dealt = (
        out.select(*base, yes, F.lit(0).alias("kind"), "i", every("q"))
        .unionByName(
            ins.select(*base, no, F.lit(0).alias("kind"), F.col("i").alias("x"), every("p"))
            .withColumnRenamed("j", "i")
            .withColumnRenamed("x", "j")
        )
        .unionByName(
            out.select(*base, yes, F.lit(1).alias("kind"), "i", every("p")).select(
                *base, "outside", "kind", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")
            )
        )
    )
    return (
        dealt.join(sets, "node")
        .groupBy("main", "kind", "i", "j")
        .applyInArrow(_compare_blocks(percent), "a long, b long")
    )


def near_links(docs: DataFrame, nodes: DataFrame, percent: int, words: int) -> DataFrame:
    """Enough similar pairs ``(a, b)`` of ``nodes`` (node, sig, bands) to span every component."""
    keyed = nodes.select("node", F.explode("bands").alias("key"))
    buckets = shared.stored(
        keyed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub"))
        .filter("n > 1")
        .select("key", "hub"),
        "buckets",
    )
    members = shared.stored(
        nodes.select("node", "sig", F.explode("bands").alias("key"))
        .join(buckets, "key")
        .withColumn("component", F.col("node")),
        "members",
    )

    # Every member against the hub of its bucket.
    hubs = members.filter("node = hub").select(
        "key", "hub", F.col("sig").alias("hub_sig"), F.col("component").alias("hub_component")
    )
    star = shared.stored(_candidates(hubs, members.drop("hub"), percent), "pairs")
    ends = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node")))
    links = shared.stored(_similar(star, _sets_of(docs, ends, words), percent), "links")

    # Members outside the hub's component, by that component.
    labels = components(links)
    members = shared.stored(_members_with(members, labels), "members")
    mains = members.filter("node = hub").select("key", F.col("component").alias("main"))
    outside = shared.stored(
        members.join(mains, "key").filter("component <> main"), "outside"
    )
    attached = outside.select("main", "node", "component").distinct()
    crowded = shared.stored(
        attached.groupBy("main")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > FEW)
        .select("main"),
        "crowded",
    )
    few = outside.join(crowded, "main", "left_anti").select(
        "key",
        F.col("node").alias("hub"),
        F.col("sig").alias("hub_sig"),
        F.col("component").alias("hub_component"),
    )
    rest = shared.stored(_candidates(few, members.drop("hub"), percent), "pairs")
    many = shared.stored(attached.join(crowded, "main", "left_semi"), "many")
    single = crowded.select("main", F.col("main").alias("node"), F.col("main").alias("component"))
    inside = shared.stored(
        labels.join(crowded.withColumnRenamed("main", "component"), "component", "left_semi")
        .select(F.col("component").alias("main"), "node", "component")
        .unionByName(single)
        .distinct(),
        "inside",
    )
    wanted = many.select("node").unionByName(inside.select("node"))
    for end in ("a", "b"):
        wanted = wanted.unionByName(rest.select(F.col(end).alias("node")))
    sets = shared.stored(_sets_of(docs, wanted, words), "sets")
    more = _similar(rest, sets, percent).unionByName(_blocks(many, inside, sets, percent))
    return links.unionByName(more)


def _components(docs: DataFrame, percent: int, words: int) -> tuple[DataFrame, DataFrame]:
    """``signatures`` of all rows, and the component of each distinct set that has a doc_id."""
    shared.ship(docs.sparkSession)
    signed = shared.stored(signatures(docs, words), "signatures")
    full = signed.filter("n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    nodes = shared.stored(
        full.filter("doc_id is not null")
        .groupBy(*key)
        .agg(
            F.min("doc_id").alias("node"),
            F.any_value("sig").alias("sig"),
            F.any_value("bands").alias("bands"),
        ),
        "nodes",
    )
    links = near_links(docs, nodes, percent, words)
    # Rows of one doc_id, but of different texts, are tied together by links to one another.
    repeated = full.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = (
        full.join(repeated.select("doc_id"), "doc_id")
        .join(nodes.select(*key, "node"), key)
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    labels = components(links.unionByName(same))
    named = shared.stored(
        nodes.select(*key, "node")
        .join(labels, "node", "left")
        .select(*key, F.coalesce("component", "node").alias("component_id")),
        "components",
    )
    return signed, named


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (doc_id, text).

    Documents with 100 * intersection >= percent * union of their sets are linked; a component is
    named by its smallest doc_id, and that document is kept. A null, empty or wordless text is its
    own component. Rows of one doc_id are one document: what any of them is linked to, all are. A
    row without a doc_id belongs to the component of an equal text that has one, else to none
    (null), and is kept in the latter case only. Other columns of ``docs`` are not looked at.
    """
    signed, named = _components(docs, percent, words)
    key = ["set_a", "set_b", "n_shingles"]
    own = F.col("n_shingles") == 0
    joined = signed.select("doc_id", *key).join(named, key, "left")
    component = F.when(own, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _whole_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each of ``ids``, which repeat in ``docs``: the smallest text, null last.

    A minimum, so many rows of one doc_id never come together, and a retry chooses the same.
    """
    own = docs.select(shared.boxed(docs), F.col("doc_id").alias("id"))
    own = own.join(ids.select(F.col("id").alias("again")), F.col("id") == F.col("again"), "left_semi")
    order = F.struct(
        F.col("doc.text").isNull(),
        F.coalesce(F.col("doc.text").cast("string"), F.lit("")),
        F.xxhash64(F.to_json("doc")),
    )
    first = own.groupBy("id").agg(F.min_by("doc", order).alias("doc"))
    return first.select(*shared.unboxed(docs))


def _rows_without_id(docs: DataFrame, named: DataFrame, words: int) -> DataFrame:
    """The rows without doc_id whose texts no document with one has."""
    rows = docs.filter("doc_id is null").select(shared.boxed(docs), F.col("text").cast("string").alias("own"))
    texts = rows.select("own").distinct().withColumn("number", F.monotonically_increasing_id())
    texts = shared.stored(texts, "texts")
    signed = signatures(texts.select(F.col("number").alias("doc_id"), F.col("own").alias("text")), words)
    copies = signed.filter("n_shingles > 0").join(named, ["set_a", "set_b", "n_shingles"], "left_semi")
    gone = texts.join(copies.select(F.col("doc_id").alias("number")), "number", "left_semi")
    gone = gone.select(F.col("own").alias("gone"))
    stay = rows.join(gone, F.col("own").eqNullSafe(F.col("gone")), "left_anti")
    return stay.select(*shared.unboxed(docs))


def drop_near_duplicates(docs: DataFrame, percent: int = 75, words: int = 5) -> DataFrame:
    """``docs`` without the documents that ``near_duplicates`` does not keep, all columns whole.

    Of rows that repeat a doc_id, the one of the smallest text stays. Rows without doc_id are
    judged one by one: those stay whose text is not also that of a document with one.
    """
    signed, named = _components(docs, percent, words)
    key = ["set_a", "set_b", "n_shingles"]
    judged = signed.filter("doc_id is not null").select("doc_id", *key).join(named, key, "left")
    own = (F.col("n_shingles") == 0) | (F.col("doc_id") == F.col("component_id"))
    kept = shared.stored(judged.filter(own).select(F.col("doc_id").alias("id")).distinct(), "kept")
    ids = docs.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("id"))
    again = shared.stored(ids.agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("id"), "again")
    # Most rows stay, so only those whose ids may be among the others are shuffled with their texts.
    every = signed.filter("doc_id is not null").select(F.col("doc_id").alias("id"))
    gone = every.join(kept, "id", "left_anti").unionByName(again.select("id"))
    gone = shared.stored(gone.distinct(), "gone")
    rows = docs.select(shared.boxed(docs), F.col("doc_id").cast("long").alias("own"))
    rows = rows.filter("own is not null")
    doubtful = shared.may_be_among(gone, F.xxhash64("id"), F.xxhash64("own"))
    checked = rows.filter(doubtful).join(gone, F.col("own") == F.col("id"), "left_anti")
    stay = rows.filter(~doubtful).unionByName(checked).select(*shared.unboxed(docs))
    if not again.isEmpty():
        stay = stay.unionByName(_whole_rows(docs, kept.join(again, "id", "left_semi")))
    if not docs.filter("doc_id is null").isEmpty():
        stay = stay.unionByName(_rows_without_id(docs, named, words))
    return stay
