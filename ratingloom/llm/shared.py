"""Where intermediate tables live, and how many partitions to ask for."""

import ctypes
import gc
import shutil
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Size of the bit maps that say which rows of a wide table a narrow one may want.
FILTER_BITS = 1 << 24
#: Bytes of a batch of texts: four slices of 1 MB, with room for the other columns.
BATCH_BYTES = (4 << 20) - (1 << 16)
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_LIMIT = "67108864b"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    A session without one gets a temporary folder if it is local; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts lineage, survives lost executors, and lets adaptive execution measure and split what
    is joined next.
    """
    path = path or new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, to be sized to the data by whoever runs it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors that do not have it installed, once a session."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='llm-')}/{__package__.split('.')[0]}_llm",
        "zip",
        root,
        Path(__file__).resolve().parents[1].name,
    )
    context.addPyFile(archive)
    context._llm_shipped = True


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python workers in batches of ``BATCH_BYTES``, or of one row if that is more.

    Spark cuts batches by rows, up to 64 MB; an executor holds some of them at once for each task,
    on both sides and outside the heap. A session that sets its own limit keeps it.
    """
    if spark.conf.get(_BATCH_LIMIT) == _DEFAULT_LIMIT:
        spark.conf.set(_BATCH_LIMIT, BATCH_BYTES)


def _bit_map(wanted: DataFrame, hashed: Column) -> np.ndarray:
    """``FILTER_BITS`` bits, whatever the input, as longs; those of the hashes of ``wanted`` are set."""
    place = F.pmod(hashed, F.lit(FILTER_BITS))
    longs = (
        wanted.select(place.alias("place"))
        .select(
            F.floor(F.col("place") / 64).cast("long").alias("at"),
            F.expr("shiftleft(1L, int(place % 64))").alias("bit"),
        )
        .groupBy("at")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(FILTER_BITS // 64, np.int64)
    bitmap[longs["at"].to_numpy()] = longs["bits"].to_numpy()
    return bitmap


def bit_filter(wanted: DataFrame, hashed: Column):
    """A broadcast bit map of the 64-bit hashes of ``wanted``, for ``may_hold``.

    It has ``FILTER_BITS`` bits whatever the input, so it costs two megabytes. Where it fills up
    it lets more rows through; what it turns away is never wanted.
    """
    return wanted.sparkSession.sparkContext.broadcast(_bit_map(wanted, hashed).tobytes())


def may_be_among(wanted: DataFrame, hashed: Column, asked: Column) -> Column:
    """Whether the bit map of ``bit_filter`` may hold the hash ``asked``, for use in SQL."""
    spark = wanted.sparkSession
    bits = pa.ListArray.from_arrays([0, FILTER_BITS // 64], pa.array(_bit_map(wanted, hashed)))
    row = stored(spark.createDataFrame(pa.table({"bits": bits})), "bits")
    place = F.pmod(asked, F.lit(FILTER_BITS))
    word = F.get(row.select("bits").scalar(), F.floor(place / 64).cast("int"))
    return F.getbit(word, (place % 64).cast("int")) == 1


def may_hold(bits, hashed: np.ndarray) -> np.ndarray:
    """Which of the hashes the broadcast bit map may hold; its bits are tested where they lie."""
    held = np.frombuffer(bits.value, np.uint8)
    place = hashed & (8 * len(held) - 1)
    return (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


_kept: dict[str, dict] = {}


def only(owner: str) -> dict:
    """What a Python worker keeps between tasks for ``owner``; what it kept for others goes.

    Workers serve one stage after another, so else each would hold the tables of all of them.
    """
    if owner not in _kept:
        if _kept:
            _kept.clear()
            trim()
        _kept[owner] = {}
    return _kept[owner]


def trim() -> None:
    """At the end of a task, give freed memory back: an idle worker should not hold on to it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    release = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if release is not None:
        release(0)


def boxed(docs: DataFrame, name: str = "doc") -> Column:
    """All columns of ``docs`` in one, out of the way of an operator's own names."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def unboxed(docs: DataFrame, name: str = "doc") -> list[Column]:
    return [F.col(name)[c].alias(c) for c in docs.columns]
