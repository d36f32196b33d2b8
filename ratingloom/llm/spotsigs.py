"""Document fingerprints by SpotSigs, in DataFrame functions only.

An anchor is a common word right before a content word. Its signature is the anchor, that content
word and the next one, whatever common words stand between. A document's fingerprint is the set of
its signatures, which sit in running prose and not in lists, tables or navigation. Similar sets
have similar lengths, so sets are told apart by length before they are compared.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import shared

#: Common words of English, German, French and Spanish that serve as anchors.
COMMON = (
    "a an and are as at be by for from he in is it of on or that the this to was were with "
    "als auf das dem den der des die ein eine ist mit nicht sich und von zu "
    "au aux avec ce dans des du est et il la le les par pas pour que qui sur un une "
    "al con de del el en es la las lo los no para por que se su un una y"
).split()
_NOT_WORD = r"[^\p{L}\p{N}]+"
#: Buckets of the document order for each shuffle partition.
_BUCKETS = 4


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``, the sorted distinct 32-bit signatures of the column ``text``.

    A text without an anchor before a content word has one signature, of the whole text.
    """
    words, common, content = f"{out}__words", f"{out}__common", f"{out}__content"
    df = df.withColumn(words, F.split(F.lower(text), _NOT_WORD, -1))
    df = df.withColumn(common, F.transform(words, lambda w: w.isin(*sorted(set(COMMON)))))
    positions = F.sequence(F.lit(0), F.size(words) - 1)
    df = df.withColumn(
        content, F.filter(positions, lambda i: ~F.get(common, i) & (F.get(words, i) != ""))
    )

    def signature(i: Column, k: Column) -> Column:
        follows = (i > 0) & F.coalesce(F.get(common, i - 1), F.lit(False))
        after = F.get(words, F.get(content, k + 1))
        return F.when(follows, F.hash(F.get(words, i - 1), F.get(words, i), after))

    found = F.array_compact(F.transform(content, signature))
    df = df.withColumn(out, F.array_distinct(found)).drop(words, common, content)
    whole = F.array(F.hash(F.lower(text)))
    return df.withColumn(out, F.when(F.size(out) > 0, F.sort_array(out)).otherwise(whole))


def fingerprint(signatures: Column) -> Column:
    """The set as text: its signatures in order."""
    return F.array_join(signatures.cast("array<string>"), " ")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard similarity of two sets; 0 without comparing where lengths rule out ``least``."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    exact = both / (F.size(a) + F.size(b) - both)
    return F.when(shorter < least * longer, F.lit(0.0)).otherwise(exact)


def similar_pairs(sets: DataFrame, least: float = 0.75) -> DataFrame:
    """Pairs ``(a, b, likeness)`` of ``sets`` (node, signatures) with a likeness of ``least``.

    Sets are partitioned by length so that similar ones are in the same or in neighbouring
    partitions. There, a pair at ``least`` shares one of the rarest signatures of either set, which
    are looked up; lengths prune what meets before sets are compared. Make equal sets one node
    before. Rows without a node or a set are left out.
    """
    sets = sets.filter("node is not null and size(signatures) > 0")
    one = sets.select("node", F.explode("signatures").alias("signature"))
    counts = one.groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    length = F.size("signatures")
    ordered = (
        one.join(counts.filter("n > 1"), "signature")
        .groupBy("node")
        .agg(F.array_sort(F.collect_list(F.struct("n", "signature"))).alias("by_rarity"))
        .join(sets.withColumn("length", length), "node")
    )
    # Signatures that nobody shares are the rarest of all, and need no lookup.
    alone = F.col("length") - F.size("by_rarity")
    prefix = F.col("length") - F.ceil(F.col("length") * least) + 1 - alone
    keys = F.slice("by_rarity", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))
    band = F.floor(F.log(F.col("length")) / -F.log(F.lit(least))).cast("long")
    looked = ordered.withColumn("band", band).select(
        "node", "length", "band", F.explode(keys).alias("key")
    )
    left = looked.select(
        F.col("node").alias("a"), F.col("length").alias("la"), F.col("key.signature").alias("s"),
        F.explode(F.array("band", F.col("band") + 1)).alias("band"),
    )
    right = looked.select(
        F.col("node").alias("b"), F.col("length").alias("lb"), F.col("key.signature").alias("s"), "band"
    )
    fits = (F.col("la") < F.col("lb")) | ((F.col("la") == F.col("lb")) & (F.col("a") < F.col("b")))
    pairs = (
        left.join(right, ["s", "band"])
        .filter(fits & (F.col("la") >= F.col("lb") * least))
        .select("a", "b")
        .distinct()
    )
    for end in ("a", "b"):
        side = sets.select(F.col("node").alias(end), F.col("signatures").alias(f"set_{end}"))
        pairs = pairs.join(side, end)
    return pairs.select(
        "a", "b", likeness(F.col("set_a"), F.col("set_b"), least).alias("likeness")
    ).filter(F.col("likeness") >= least)


def _with_next(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``next``, a struct of ``columns`` of the row with the next (doc_id, place).

    The last row has the first one. Rows are dealt to buckets of the order by bounds found from a
    sample of the ids; the first row of each bucket, in one small table, closes the gaps.
    """
    n = _BUCKETS * shared.partitions(df.sparkSession)
    at = F.array([F.lit(k / n) for k in range(1, n)])
    bounds = df.select(F.percentile_approx("doc_id", at, F.lit(20 * n)).alias("b")).first()["b"]
    steps = sorted(set(bounds or []))
    # Two levels, so that a row looks at about twice the root of the number of bounds.
    wide = max(1, int(len(steps) ** 0.5))
    top = F.array([F.lit(b).cast("long") for b in steps[::wide]] or [F.lit(None).cast("long")])
    inner = [steps[k : k + wide] for k in range(0, len(steps), wide)] or [[]]
    low = F.array(
        *[F.array([F.lit(b).cast("long") for b in part] or [F.lit(None).cast("long")]) for part in inner]
    )

    def below(bounds: Column) -> Column:
        return F.size(F.filter(bounds, lambda b: b <= F.col("doc_id")))

    group = below(top)
    within = below(F.get(low, F.greatest(group - 1, F.lit(0))))
    order = F.struct("doc_id", "place")
    bucketed = df.withColumn("bucket", group * (wide + 1) + within)
    ahead = Window.partitionBy("bucket").orderBy("doc_id", "place")
    firsts = bucketed.groupBy("bucket").agg(
        F.min_by(F.struct(*columns), order).alias("first_row")
    )
    by_bucket = Window.partitionBy().orderBy("bucket")
    closing = firsts.select(
        F.col("bucket"),
        F.coalesce(
            F.lead("first_row").over(by_bucket),
            F.first("first_row").over(
                by_bucket.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            ),
        ).alias("after"),
    )
    inside = bucketed.withColumn("inside", F.lead(F.struct(*columns)).over(ahead))
    return (
        inside.join(shared.stored(closing, "firsts"), "bucket")
        .withColumn("next", F.coalesce("inside", "after"))
        .drop("inside", "after", "bucket")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document of ``docs`` (doc_id, text) and of its edited text.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    The edited text has the last half of its characters, rounded down, replaced by the first as
    many of the next document in ascending doc_id, the first one following the last. A null text
    is empty; a null doc_id comes first. Rows of one doc_id are ordered by their texts' digests,
    and repeated rows stand next to each other. Other columns are not looked at.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("place", F.md5("text"))
    known = with_signatures(rows, "text", "signatures")
    followed = _with_next(known, ["text", "signatures"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    kept = F.substring(F.col("text"), F.lit(1), F.char_length("text") - half)
    edited = F.concat(kept, F.substring(F.col("next.text"), F.lit(1), half))
    both = with_signatures(
        followed.select(
            "doc_id",
            F.char_length("text").cast("long").alias("n_chars"),
            edited.alias("edited"),
            "signatures",
            F.col("next.signatures").alias("next_signatures"),
        ),
        "edited",
        "edited_signatures",
    )
    own = F.col("signatures")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(F.col("edited_signatures")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_signatures")).alias("near_edited"),
        likeness(own, F.col("next_signatures")).alias("near_next"),
    )
