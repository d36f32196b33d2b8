"""Line deduplication with levelled sorted runs of line hashes.

A run is a table sorted by line hash: in how many documents a line has occurred by then, and the
largest doc_id among them. Every batch of documents is joined with the runs: hashes that no run
has are new, the others bring their totals up to date. Both make the batch's run, at level 0. When
a level holds ``FAN_IN`` runs, they are merged into one of the next level, so a hash is rewritten
a logarithmic number of times. A later batch, today or next week, goes on from the same folder.

Dropping joins the lines with the frequent ones of the runs. Only hashes and positions of lines
that are long enough travel; texts meet the positions to drop once, by row.
"""

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.llm import shared

#: The bytes stripped at the ends of a line, and the letters lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FAN_IN = 3


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, row, position, line``: the 128-bit hash of each key of ``min_chars`` or more.

    ``row`` stands for the text of the row, so that rows which share a doc_id stay apart.
    """
    keys = F.transform(lines_of(F.col("text")), line_key)
    exploded = docs.select(
        F.col("doc_id").cast("long"),
        F.xxhash64("text").alias("row"),
        F.posexplode(keys).alias("position", "key"),
    )
    return exploded.filter(F.length("key") >= min_chars).select(
        "doc_id", "row", "position", F.unhex(F.md5("key")).alias("line")
    )


_CATALOGUE = "version long, level int, name string, added boolean"


@dataclass
class LineRuns:
    """The runs in a shared folder, by level; ``open`` takes them up again in a later session.

    The catalogue is a log in the same folder: which run was added to which level, or merged away.
    A run is written before the catalogue names it, so a job that dies leaves it as it was.
    """

    spark: SparkSession
    folder: str
    levels: list[list[str]] = field(default_factory=list)
    version: int = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> "LineRuns":
        """The runs that the catalogue in ``folder`` names."""
        log = spark.read.schema(_CATALOGUE).parquet(f"{folder}/catalogue")
        runs = cls(spark, folder)
        for entry in log.orderBy("version").toLocalIterator():
            runs._apply(entry["version"], entry["level"], entry["name"], entry["added"])
        return runs

    def _apply(self, version: int, level: int, name: str, added: bool) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        (self.levels[level].append if added else self.levels[level].remove)(name)
        self.version = version

    def _log(self, entries: list[tuple[int, str, bool]]) -> None:
        rows = [(self.version + k, *entry) for k, entry in enumerate(entries, 1)]
        log = self.spark.createDataFrame(rows, _CATALOGUE).coalesce(1)
        log.write.mode("append").parquet(f"{self.folder}/catalogue")
        for row in rows:
            self._apply(*row)

    def _write(self, run: DataFrame, level: int) -> str:
        """A run, sorted: each partition has its range of hashes."""
        name = f"run-{level}-{uuid.uuid4().hex}"
        n = shared.partitions(self.spark)
        share = F.conv(F.substring(F.hex("line"), 1, 6), 16, 10).cast("long") / F.lit(1 << 24)
        dealt = run.repartitionById(n, F.floor(share * n).cast("int"))
        dealt.sortWithinPartitions("line").write.parquet(f"{self.folder}/{name}")
        return name

    def _read(self, names: list[str]) -> DataFrame:
        """The latest entry of each line. Entries are totals, so it is the largest."""
        paths = [f"{self.folder}/{name}" for name in names]
        runs = self.spark.read.schema("line binary, n_docs long, keeper long").parquet(*paths)
        if len(names) == 1:
            return runs
        return runs.groupBy("line").agg(
            F.max("n_docs").alias("n_docs"), F.max("keeper").alias("keeper")
        )

    def totals(self) -> DataFrame | None:
        names = [name for level in self.levels for name in level]
        return self._read(names) if names else None

    def add(self, lines: DataFrame) -> None:
        """Join a batch with the runs and add its run. A document's lines must come in one batch.

        Lines that no run has enter with the batch's counts; the others with their totals so far,
        which supersede the entries in older runs. Runs of a full level are then merged.
        """
        once = lines.select("line", "doc_id").distinct()
        batch = once.groupBy("line").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper")
        )
        before = self.totals()
        if before is not None:
            before = before.withColumnsRenamed({"n_docs": "n_before", "keeper": "keeper_before"})
            batch = batch.join(before, "line", "left").select(
                "line",
                (F.col("n_docs") + F.coalesce("n_before", F.lit(0))).alias("n_docs"),
                F.greatest("keeper", "keeper_before").alias("keeper"),
            )
        self._log([(0, self._write(batch, 0), True)])
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= FAN_IN:
            old = list(self.levels[level])
            merged = self._write(self._read(old), level + 1)
            self._log([(level + 1, merged, True), *[(level, name, False) for name in old]])
            level += 1

    def frequent(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """``line, keeper`` of lines in at least ``min_docs`` documents."""
        return self.totals().filter(F.col("n_docs") >= min_docs).select("line", "keeper")


def dropped_lines(
    docs: DataFrame,
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    batches: int = BATCHES,
) -> DataFrame:
    """``doc_id, row, drop``: for each row that loses lines, their positions."""
    hashed = shared.stored(line_hashes(docs, min_chars), "lines")
    runs = LineRuns(docs.sparkSession, shared.new_path(docs.sparkSession, "runs"))
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for b in range(batches):
        runs.add(hashed.filter(batch == b))
    frequent = shared.stored(runs.frequent(min_docs).sortWithinPartitions("line"), "frequent")
    return (
        hashed.join(frequent, "line")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "row")
        .agg(F.collect_set("position").alias("drop"))
    )


def _cleaned(docs: DataFrame, **parameters) -> DataFrame:
    """``doc`` with the columns of ``docs``, its ``lines``, and ``kept``, the positions that stay."""
    drop = dropped_lines(docs, **parameters).select(
        F.col("doc_id").alias("drop_id"), F.col("row").alias("drop_row"), "drop"
    )
    left = docs.select(
        shared.boxed(docs), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("row")
    )
    same = F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("row") == F.col("drop_row"))
    lines = lines_of(F.col("doc.text"))
    every = F.sequence(F.lit(0), F.size("lines") - 1)
    return (
        left.join(drop, same, "left")
        .select("doc", "id", "drop", lines.alias("lines"))
        .withColumn(
            "kept", F.when(F.col("drop").isNull(), every).otherwise(F.array_except(every, "drop"))
        )
    )


def _text() -> Column:
    lines = F.transform("kept", lambda i: F.get("lines", i))
    whole = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    return F.when(F.col("drop").isNull(), whole).otherwise(F.array_join(lines, "\n"))


def dedup_lines(docs: DataFrame, **parameters) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_text`` for every row of ``docs`` (doc_id, text).

    A line's key is the line without blanks at its ends, A-Z lower-cased. A key of at least
    ``min_chars`` characters in at least ``min_docs`` documents loses its lines in all but the
    largest doc_id. Rows of one doc_id are one document, and so are those without, which are the
    smallest. A null or empty text is one empty line. Other columns are not looked at.
    """
    cleaned = _cleaned(docs.select("doc_id", "text"), **parameters)
    n = F.size("lines")
    return cleaned.select(
        F.col("id").alias("doc_id"),
        n.cast("long").alias("n_lines"),
        (n - F.size("kept")).cast("long").alias("n_dropped"),
        _text().alias("kept_text"),
    )


def without_repeated_lines(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with its columns, ``text`` without the dropped lines; null stays null.

    An integer column ``n_chars`` is set anew.
    """
    changed = {"text": F.when(F.col("doc.text").isNotNull(), _text())}
    cleaned = _cleaned(docs, **parameters).withColumn("text", changed["text"])
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    changed["text"] = F.col("text")
    return cleaned.select(
        *[changed.get(c, F.col("doc")[c]).alias(c) for c in docs.columns]
    )
