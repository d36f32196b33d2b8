"""Near-duplicate vectors by sorted projection passes, completed by cells where they overlook pairs.

A pass orders the vectors of each label and dimension lexicographically by a key of concatenated
random hashes: the sides of ``BITS`` random planes through a centre of the label. The order is cut
into windows of ``window_rows`` vectors, and each window is compared with itself and with the one
before it, by matrix products. A task takes ``RUN`` windows and the one before them. Every vector carries its windows in all passes, so a pair that
several passes bring together is counted in the first of them only. A label that fits a window
has one pass, which compares it whole.

Passes can overlook pairs of a crowded label, so what they leave is looked up in cells. A vector's
cell is that of the pivot, drawn from the label by a hash, with the largest product. Vectors x of
cell i and y of cell j at a distance of at most t both have products with the two pivots that
differ by at most t times the distance of the pivots, so only those near the border of two cells
can be linked across it; nothing else is left out. Cells are dealt to blocks of bounded size, and
pairs of blocks are compared but for the pairs that shared a window. A label so dense that all its
vectors lie near all borders is compared whole, in time that grows with the square of its size.

Pivots and sizes stay in tables; a task sees those of one label. Equal vectors are one node from
the start. A comparison reports a count per vector and the links that connect, not every pair. So
a block of n near copies makes rows in proportion to n.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.graph import components

BLOCK = 4096
MAX_PIVOTS = 1024
PASSES = 4
BITS = 62
RUN = 4
_FLOATS = 1 << 20
_TILE = 1024
#: Cells are numbered above, the blocks of a cell in the lower bits.
_BLOCK_BITS = 24


def _usable(vector: Column) -> Column:
    """Not null, and neither zero nor holding a null, NaN or infinite component."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one dimension, scaled to length 1."""
    v = np.asarray(column.flatten(), np.float64).reshape(-1, dim)
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _block_rows(dim: Column) -> Column:
    """Vectors of a block, so that it has a bounded size."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(_FLOATS) / dim))).cast("long")


def window_rows(dim: Column) -> Column:
    """Vectors of a window, so that ``RUN`` of them are about a block."""
    return F.greatest(F.lit(1), F.floor(_block_rows(dim) / RUN)).cast("long")


def _pivots(large: DataFrame) -> DataFrame:
    """Pivots of each label and dimension, numbered as cells; at most ``MAX_PIVOTS`` of each.

    Four times as many are drawn by a hash and those of the smallest hashes stay. A label from
    which none is drawn, which has few blocks then, is one cell.
    """
    wanted = F.least(F.lit(MAX_PIVOTS), F.ceil(F.col("n") / _block_rows(F.col("dim"))))
    share = F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(1 << 30))
    drawn = (
        large.withColumn("wanted", wanted)
        .withColumn("share", share)
        .filter(F.col("share") * F.col("n") < 4 * F.col("wanted") * F.lit(float(1 << 30)))
    )
    by_share = Window.partitionBy("label", "dim").orderBy("share", "node")
    return (
        drawn.withColumn("cell", (F.row_number().over(by_share) - 1).cast("int"))
        .filter(F.col("cell") < F.col("wanted"))
        .select("label", "dim", "slices", "cell", F.col("vector").alias("pivot"))
    )


_ASSIGNED = (
    "label long, dim int, n long, node long, copies long, vector array<float>, "
    "keys array<long>, cell int, near array<int>"
)


def _assign(cosine: float):
    """Of a slice of a label: the keys of its vectors in all passes, their cells, and the cells
    near whose border they lie."""
    # Rounding of the products must not part what belongs together.
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6
    passes, bits = PASSES, BITS

    def assign(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        names = ["label", "dim", "n", "node", "copies", "vector"]
        if not rows.num_rows:
            empty = pa.schema(
                [rows.schema.field(c) for c in names]
                + [("keys", pa.list_(pa.int64())), ("cell", pa.int32()), ("near", pa.list_(pa.int32()))]
            )
            return empty.empty_table()
        dim = rows["dim"][0].as_py()
        p = np.zeros((1, dim))
        if pivots.num_rows:
            order = np.argsort(pivots["cell"].to_numpy())
            p = _matrix(pivots["pivot"].take(pa.array(order)).combine_chunks(), dim)
        planes = np.random.Generator(np.random.PCG64([7, dim])).standard_normal((dim, passes * bits))
        weights = np.int64(1) << np.arange(bits - 1, -1, -1, dtype=np.int64)
        centre = p.mean(0)
        vectors = rows["vector"].combine_chunks()
        keys, homes, near, counts = [], [], [], []
        for low in range(0, rows.num_rows, 256):
            unit = _matrix(vectors.slice(low, 256), dim)
            side = ((unit - centre) @ planes > 0).reshape(len(unit), passes, bits)
            keys.append((side * weights).sum(2))
            product = unit @ p.T
            home = product.argmax(1)
            gap = product[np.arange(len(unit)), home][:, None] - product
            apart = np.sqrt(np.maximum(0, 2 - 2 * (p[home] @ p.T)))
            row, cell = np.nonzero(gap <= reach * apart + 1e-6)
            homes.append(home)
            near.append(cell)
            counts.append(np.bincount(row, minlength=len(unit)))
        ends = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
        return rows.select(names).combine_chunks().append_column(
            "keys",
            pa.ListArray.from_arrays(
                pa.array(np.arange(rows.num_rows + 1) * passes, pa.int32()),
                pa.array(np.concatenate(keys).ravel(), pa.int64()),
            ),
        ).append_column("cell", pa.array(np.concatenate(homes), pa.int32())).append_column(
            "near",
            pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.concatenate(near), pa.int32())
            ),
        )

    return assign


def _assigned(nodes: DataFrame, cosine: float) -> DataFrame:
    """Every node with its keys in the passes of its label; cells where those are several."""
    sizes = shared.stored(
        nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")), "label-sizes"
    )
    sized = nodes.drop("first").join(sizes, ["label", "dim"])
    crowded = F.col("n") > window_rows(F.col("dim"))
    slices = F.ceil(F.col("n") / (4 * _block_rows(F.col("dim"))))
    large = sized.filter(crowded).withColumn("slices", slices)
    spread = large.withColumn("slice", F.pmod(F.xxhash64("node", F.lit("slice")), F.col("slices")))
    copied = shared.stored(_pivots(large), "pivots").select(
        "label", "dim", "cell", "pivot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice")
    )
    by = ["label", "dim", "slice"]
    kept = ["label", "dim", "n", "node", "copies", "vector"]
    placed = (
        spread.select("slice", *kept)
        .groupBy(*by)
        .cogroup(copied.groupBy(*by))
        .applyInArrow(_assign(cosine), _ASSIGNED)
    )
    small = sized.filter(~crowded).select(
        *kept,
        F.array(F.lit(0).cast("long")).alias("keys"),
        F.lit(0).alias("cell"),
        F.array().cast("array<int>").alias("near"),
    )
    return shared.stored(placed.unionByName(small), "assigned")


def _windows(assigned: DataFrame) -> DataFrame:
    """``node, seen``: the window of each node in every pass of its label, in order.

    Rows of all passes are range-partitioned and sorted; a row's place is that in its partition
    plus the sizes of earlier ones. Only one count per partition comes together.
    """
    spark = assigned.sparkSession
    order = ["label", "dim", "pass", "key", "node"]
    keyed = assigned.select("label", "dim", "node", F.posexplode("keys").alias("pass", "key"))
    placed = shared.stored(
        keyed.repartitionByRange(shared.partitions(spark), *order)
        .sortWithinPartitions(*order)
        .select("node", "dim", "pass", F.monotonically_increasing_id().alias("place")),
        "order",
    )
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    window = F.floor(place / window_rows(F.col("dim"))).cast("long")
    # One row per shuffle partition: the setting bounds what is broadcast.
    ranked = placed.join(F.broadcast(shared.stored(starts, "starts")), part == F.col("part"))
    return (
        ranked.select("node", F.struct("pass", window.alias("window")).alias("at"))
        .groupBy("node")
        .agg(F.array_sort(F.collect_list("at")).alias("at"))
        .select("node", F.col("at.window").alias("seen"))
    )


def _deal(nodes: DataFrame, cosine: float) -> DataFrame:
    """Vectors under every run of windows, and every pair of blocks ``i <= j``, that is compared.

    In a run, ``side`` tells its own vectors (1) from those of the window before it (0); in a pair
    of blocks, those of j from those of i. ``step`` is the pass; blocks come after all passes.
    """
    assigned = _assigned(nodes, cosine)
    placed = shared.stored(assigned.join(_windows(assigned), "node"), "placed")
    row = ["label", "dim", "node", "copies", "vector", "seen"]
    run = F.floor(F.col("at") / RUN).cast("long")
    last = F.col("at") % RUN == RUN - 1
    windows = placed.select(*row, F.posexplode("seen").alias("step", "at")).select(
        *row,
        "step",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(run.alias("i"), F.lit(1).alias("side")),
                    F.when(last, F.struct((run + 1).alias("i"), F.lit(0).alias("side"))),
                )
            )
        ).alias("to"),
    )
    windows = windows.select(*row, "step", "to.i", F.col("to.i").alias("j"), "to.side")

    celled = placed.filter(F.size("near") > 0)
    blocks = shared.stored(
        celled.groupBy("label", "dim", "cell")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("label", "dim", "cell", F.ceil(F.col("n") / _block_rows(F.col("dim"))).alias("blocks")),
        "blocks",
    )
    wide = F.lit(1 << _BLOCK_BITS)
    own = F.col("cell") * wide + F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    other = F.col("to_cell") * wide + F.col("to_block")
    other_blocks = blocks.select(
        "label", "dim", F.col("cell").alias("to_cell"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("to_block"),
    )
    cells = (
        celled.join(blocks, ["label", "dim", "cell"])
        .select(*row, own.alias("own"), F.explode("near").alias("to_cell"))
        .join(other_blocks, ["label", "dim", "to_cell"])
        .withColumn("other", other)
        .select(
            *row,
            F.size("seen").alias("step"),
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.when(F.col("own") >= F.col("other"), F.lit(1)).otherwise(F.lit(0)).alias("side"),
        )
    )
    return windows.unionByName(cells)


def _near(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs reach the cosine: by single precision where it decides, else by double."""
    slack = 1e-5 + 2.5e-7 * left.shape[1]
    rough = left.astype(np.float32) @ right.astype(np.float32).T
    near = rough >= cosine + slack
    x, y = np.nonzero((rough >= cosine - slack) & ~near)
    for k in range(0, len(x), 1 << 14):
        a, b = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
        near[a, b] = np.einsum("ij,ij->i", left[a], right[b]) >= cosine
    return near


def _compare(cosine: float):
    """Of a run of windows or a pair of blocks: link counts (b null) and links that connect (n null).

    Pairs that shared a window of an earlier pass were compared there.
    """

    def compare(table: pa.Table) -> pa.Table:
        i, j, dim, step = (table[n][0].as_py() for n in ("i", "j", "dim", "step"))
        side, node = table["side"].to_numpy(), table["node"].to_numpy()
        copies = table["copies"].to_numpy()
        seen = table["seen"].combine_chunks().flatten().to_numpy().reshape(len(side), -1)
        unit = _matrix(table["vector"].combine_chunks(), dim)
        own, before = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        if step < seen.shape[1]:
            at = seen[:, step]
            parts = [
                (own[at[own] == w], np.flatnonzero(at == w - 1), True) for w in np.unique(at[own])
            ]
        else:
            parts = [(own, before, i == j)]
        n = np.zeros(len(side), np.int64)
        group, links = np.arange(len(side)), []
        for own, before, inner in parts:
            others = np.concatenate((own, before)) if inner else before
            for low in range(0, len(own) if len(others) else 0, _TILE):
                rows = own[low : low + _TILE]
                near = _near(unit[rows], unit[others], cosine)
                if inner:
                    near[np.arange(len(rows)), low + np.arange(len(rows))] = False
                if not near.any():
                    continue
                for q in range(step):
                    near &= np.abs(seen[rows, q][:, None] - seen[others, q]) > 1
                n[rows] += near @ copies[others]
                if len(before):
                    n[before] += near[:, -len(before) :].T @ copies[rows]
                for r in np.flatnonzero(near.any(1)):
                    x, y = rows[r], others[near[r]]
                    new, at = np.unique(group[y], return_index=True)
                    at = at[new != group[x]]
                    if len(at):
                        links += [(int(node[x]), int(node[b])) for b in y[at]]
                        lead = np.arange(len(side))
                        lead[new] = group[x]
                        group = lead[group]
        some = np.flatnonzero(n)
        a, b = zip(*links) if links else ((), ())
        return pa.table(
            {
                "a": pa.array([*node[some].tolist(), *a], pa.int64()),
                "b": pa.array([None] * len(some) + list(b), pa.int64()),
                "n": pa.array([*n[some].tolist(), *([None] * len(links))], pa.int64()),
                "step": pa.array([step] * (len(some) + len(links)), pa.int32()),
            }
        )

    return compare


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    ``vectors`` has vec_id, embedding and label. Vectors of equal label and dimension are linked
    at a cosine of at least ``cosine``, in double precision. A null label or embedding, a zero
    vector, and a vector with a null or non-finite component link with nothing. Repeated rows are
    vectors of their own, linked with each other. A row without vec_id counts as a link of others;
    its component is named after those that have an id, or else by null, and then it is kept.
    Distinct vectors are told apart by a 64-bit hash. Other columns are not looked at.
    """
    shared.ship(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.col("embedding").cast("array<float>").alias("vector"),
    )
    usable = F.col("label").isNotNull() & _usable(F.col("vector"))
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("label", "vector")))
    nodes = shared.stored(
        rows.filter("node is not null")
        .groupBy("node")
        .agg(
            F.any_value("label").alias("label"),
            F.any_value("vector").alias("vector"),
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("first"),
        )
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    compared = shared.stored(
        _deal(nodes, cosine)
        .groupBy("label", "dim", "step", "i", "j")
        .applyInArrow(_compare(cosine), "a long, b long, n long, step int"),
        "compared",
    )
    labels = components(compared.filter("b is not null").select("a", "b"))
    counts = compared.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    named = (
        labels.join(nodes.select("node", "first"), "node")
        .groupBy("component")
        .agg(F.min("first").alias("component_id"))
    )
    known = shared.stored(
        nodes.select("node", "copies", "first")
        .join(labels, "node", "left")
        .join(named, "component", "left")
        .join(counts, "node", "left")
        .select(
            "node",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id"),
        ),
        "known",
    )
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.select("vec_id", "node")
        .join(known, "node", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
            F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
        )
    )
