"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks.

Each source's documents are put in a fixed pseudo-random order and laid end to end; blocks of
``BLOCK`` words are cut from that stream, across documents. The mix is a sequence of slots. Slot k
has the van der Corput point of k, which falls into one source's share of the unit interval, so
any run of slots is close to the targets. A source's slots are ranked, and rank r takes block r of
its stream, starting over at the end; the last slot of a source takes only what its target lacks.

Targets, sources and blocks are tables, not driver state. Positions in a stream come from sums per
bucket of a source and running sums inside a bucket, ranks likewise, so a source that holds most
of the rows is spread over as many tasks as it has buckets.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import shared

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 1024
SEED = "mix"
#: Rows per bucket of a source's stream, slots per chunk of the schedule.
_BUCKET_ROWS = 8192
_CHUNK_SLOTS = 1 << 16


def _long(column: Column) -> Column:
    return column.cast("long")


def sized(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``doc_id, source, size, shuffled``: words of each document and its place in the shuffle."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        _long(F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0))).alias(
            "size"
        ),
        _long(F.conv(F.substring(F.md5(name), 1, 15), 16, 10)).alias("shuffled"),
    )


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """One row per source: ``source_no, source, rows, source_size, target``.

    Sources in code point order, null last, have ``weights`` in turn and share the sum of all
    sizes. None gets more than ``most`` times its size; what it may not have goes to the others by
    weight. That is a level under which ``level * weight`` is capped for the sources of the
    smallest ``most * size / weight``. The windows run over one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    per_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")
    )
    turn = F.get(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights))
    filling = Window.partitionBy().orderBy(
        F.col("cap") / F.col("weight"), F.col("source_no")
    )
    upto = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(upto), F.lit(0))
    return (
        per_source.withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", turn)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("place", F.row_number().over(filling))
        .withColumn("level", left.cast("double") / F.sum("weight").over(onward))
        .withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn("first", F.min(F.when(~F.col("full"), F.col("place"))).over(everything))
        .withColumn(
            "level", F.max(F.when(F.col("place") == F.col("first"), F.col("level"))).over(everything)
        )
        .withColumn(
            "target",
            F.when(F.col("place") >= F.col("first"), F.col("level") * F.col("weight")).otherwise(
                F.col("cap").cast("double")
            ),
        )
        .select("source_no", "source", "rows", "source_size", "target")
    )


def van_der_corput(k: Column) -> Column:
    """The bits of ``k`` mirrored at the binary point, exact for k below 2**52."""
    mirrored = F.reverse(F.lpad(F.bin(k), 52, "0"))
    return _long(F.conv(mirrored, 2, 10)) / F.lit(2.0**52)


def _with_slots(sources: DataFrame, block: int) -> DataFrame:
    """What each source takes: whole rounds of its stream, then ``rest`` words of one more."""
    size = F.col("source_size")
    return (
        sources.withColumn("take", _long(F.round("target")))
        .withColumn("rounds", F.when(size > 0, _long(F.floor(F.col("take") / size))).otherwise(0))
        .withColumn("rest", F.col("take") - F.col("rounds") * size)
        .withColumn("blocks", _long(F.ceil(size / block)))
        .withColumn("slots", F.col("rounds") * F.col("blocks") + _long(F.ceil(F.col("rest") / block)))
    )


def schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix: ``slot, source_no, rank, block, start, end``, the last two in words of the stream.

    ``sources`` is the table of ``targets``. The points give each source its slots to within a few;
    where they give one too many it is left out, and those that lack one have it at the end.
    """
    spark = sources.sparkSession
    before = Window.partitionBy().orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    shares = shared.stored(
        _with_slots(sources, block).withColumn(
            "before", F.coalesce(F.sum("slots").over(before), F.lit(0))
        ),
        "shares",
    )
    total, n_sources = shares.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    # Cells of the unit interval; a point looks for its source among those that meet its cell.
    cells = max(1024, 1 << (4 * n_sources).bit_length())
    low = F.col("before") / F.lit(max(total, 1))
    high = (F.col("before") + F.col("slots")) / F.lit(max(total, 1))
    last_cell = F.least(F.lit(cells - 1), F.ceil(high * cells) - 1)
    by_cell = shares.filter("slots > 0").select(
        "source_no",
        low.alias("low"),
        high.alias("high"),
        F.explode(F.sequence(_long(F.floor(low * cells)), _long(last_cell))).alias("cell"),
    )
    point = van_der_corput(F.col("slot"))
    points = spark.range(total).withColumnRenamed("id", "slot").withColumn("point", point)
    chosen = (
        points.withColumn("cell", _long(F.floor(F.col("point") * cells)))
        .join(shared.stored(by_cell, "cells"), "cell")
        .filter("point >= low and point < high")
        .select("slot", "source_no", _long(F.floor(F.col("slot") / _CHUNK_SLOTS)).alias("chunk"))
    )
    per_chunk = chosen.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source_no").orderBy("chunk")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    first = per_chunk.select(
        "source_no", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
    in_chunk = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = (
        chosen.withColumn("k", F.row_number().over(in_chunk) - 1)
        .join(first, ["source_no", "chunk"])
        .select("slot", "source_no", (F.col("first") + F.col("k")).alias("rank"))
    )
    got = per_chunk.groupBy("source_no").agg(F.sum("n").alias("got"))
    lacking = (
        shares.join(got, "source_no", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .filter("got < slots")
        .select(
            "source_no", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)).alias("rank")
        )
        .select((F.lit(total) + F.col("rank")).alias("slot"), "source_no", "rank")
    )
    start = F.col("block") * block
    whole = F.least(start + block, F.col("source_size"))
    partial = F.least(whole, F.col("rest"))
    return (
        ranked.unionByName(lacking)
        .join(
            shares.select("source_no", "source_size", "slots", "blocks", "rounds", "rest"), "source_no"
        )
        .filter("rank < slots")
        .withColumn("block", F.col("rank") % F.col("blocks"))
        .withColumn("round", _long(F.floor(F.col("rank") / F.col("blocks"))))
        .select(
            "slot",
            "source_no",
            "rank",
            "block",
            start.alias("start"),
            F.when(F.col("round") < F.col("rounds"), whole).otherwise(partial).alias("end"),
        )
    )


def streams(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """``sizes`` with ``source_no, source_size, target`` and the ``start`` in its source's stream."""
    buckets = F.ceil(F.col("rows") / _BUCKET_ROWS)
    bucket = _long(F.floor(F.col("shuffled") / F.lit(2.0**60) * buckets))
    placed = (
        sizes.join(
            sources.withColumnRenamed("source", "name"),
            F.col("source").eqNullSafe(F.col("name")),
        )
        .withColumn("bucket", bucket)
        .drop("name", "rows")
    )
    earlier = Window.partitionBy("source_no").orderBy("bucket")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    first = (
        placed.groupBy("source_no", "bucket")
        .agg(F.sum("size").alias("n"))
        .select(
            "source_no", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
        )
    )
    inside = Window.partitionBy("source_no", "bucket").orderBy("shuffled", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(first, ["source_no", "bucket"])
        .withColumn("start", F.col("first") + F.col("inside"))
        .drop("first", "inside", "bucket", "shuffled")
    )


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    block: int = BLOCK,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` counts the document's words in the mix, repeats included; over a source they sum up
    to its target, rounded. No document is taken more than ``most`` times. The shuffle depends on
    doc_id alone, so reruns agree; rows of equal id are ordered by size. Null source is a source
    of its own; a null or empty text has size 0 and nothing of it is taken. Only doc_id, source
    and text are looked at.
    """
    sizes = shared.stored(sized(docs, seed), "sizes")
    sources = shared.stored(targets(sizes, weights, most), "sources")
    placed = shared.stored(streams(sizes, sources), "streams")
    slots = schedule(sources, block)
    end = F.col("start") + F.col("size")
    blocks = F.sequence(_long(F.floor(F.col("start") / block)), _long(F.floor((end - 1) / block)))
    pieces = placed.filter("size > 0").select(
        "doc_id", "source_no", "start", end.alias("end"), F.explode(blocks).alias("block")
    )
    joined = pieces.alias("p").join(
        slots.alias("s"),
        (F.col("p.source_no") == F.col("s.source_no")) & (F.col("p.block") == F.col("s.block")),
    )
    overlap = F.greatest(
        F.lit(0), F.least("p.end", "s.end") - F.greatest("p.start", "s.start")
    )
    taken = (
        joined.select("p.doc_id", "p.source_no", "p.start", overlap.alias("n"))
        .groupBy("source_no", "start")
        .agg(F.sum("n").alias("taken"))
    )
    return (
        placed.join(taken, ["source_no", "start"], "left")
        .withColumn("taken", F.when(F.col("size") > 0, F.col("taken")).otherwise(0))
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The mix as whole documents, with the columns of ``docs``.

    A document comes as often as it is taken, rounded half up; one taken less than half goes.
    Rows that agree in doc_id, source and size come equally often.
    """
    takes = (
        mix(docs, **parameters)
        .groupBy("doc_id", "source", "size")
        .agg(F.sum("taken").alias("taken"), F.count(F.lit(1)).alias("n"))
        .filter("size > 0")
        .withColumn("copies", _long(F.floor(F.col("taken") / (F.col("size") * F.col("n")) + 0.5)))
        .filter("copies > 0")
    )
    size = _long(F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)))
    left = docs.select(
        shared.boxed(docs),
        F.col("doc_id").alias("own_id"),
        F.col("source").alias("own_source"),
        size.alias("own_size"),
    )
    same = (
        F.col("own_id").eqNullSafe(F.col("doc_id"))
        & F.col("own_source").eqNullSafe(F.col("source"))
        & (F.col("own_size") == F.col("size"))
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    return left.join(takes, same).select("doc", each.alias("copy")).select(*shared.unboxed(docs))
