"""Document quality by a text classifier and hierarchical empirical Bayes over sites.

Evidence of a document: how much more often its words occur in documents of one label, from all
labelled documents, and shape measures of its text. A logistic model, fitted on all labelled
documents, turns them into odds. Sites add prior odds: the share of good documents of a path
(part of a host) is shrunk towards that of its host, the host's towards the whole corpus, each by
a strength that is estimated from how much the shares of sites vary beyond chance. So a site with
few labels counts for little.

Word counts go to a table of ``BUCKETS`` hashed words, whatever the corpus.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.llm import shared
from ratingloom.llm.words import text_slices, words_of

BUCKETS = 1 << 20
#: Counts by which a word's share of labelled documents is drawn to the overall share.
WORD_STRENGTH = 10.0
#: A word is telling from this log ratio on.
TELLING = 1.0
LEAST = 0.5
GOALS = ("quality", "toxic")
SHAPE = ("log_words", "distinct", "mean_length", "symbols", "digits", "repeats", "upper")
EVIDENCE = ("most", "telling")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:'\"!?-()"]] = True
#: ASCII marks read as spaces where words are counted, so that a word's marks do not matter.
_PLAIN = np.array([b if b > 126 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


def _distinct(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words of each text without marks, and their texts."""
    found = words_of(_PLAIN[data], offsets)
    bucket = (found.hashes >> np.uint64(44)).astype(np.int64)
    key = np.unique(found.doc * np.int64(BUCKETS) + bucket)
    return key % BUCKETS, key // BUCKETS


def _word_table(labelled: DataFrame) -> np.ndarray:
    """(goal, no or yes, bucket): labelled documents that have a word of the bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(GOALS), 2, BUCKETS), np.int64)
        for batch in batches:
            goals = [
                batch.column(g).fill_null(-1).to_numpy(zero_copy_only=False) for g in GOALS
            ]
            for low, high, data, offsets in text_slices(batch.column("text")):
                bucket, doc = _distinct(data, offsets)
                for g, values in enumerate(goals):
                    for v in (0, 1):
                        of = values[low:high][doc] == v
                        sums[g, v] += np.bincount(bucket[of], minlength=BUCKETS)
        place = np.flatnonzero(sums.any((0, 1)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), *(pa.array(sums[g, v, place]) for g in (0, 1) for v in (0, 1))],
            ["bucket", "q0", "q1", "t0", "t1"],
        )

    names = ["q0", "q1", "t0", "t1"]
    counted = (
        labelled.select("text", *GOALS)
        .mapInArrow(count, "bucket long, q0 long, q1 long, t0 long, t1 long")
        .groupBy("bucket")
        .agg(*[F.sum(n).alias(n) for n in names])
        .toArrow()
    )
    table = np.zeros((len(names), BUCKETS), np.int32)
    for k, name in enumerate(names):
        table[k, counted["bucket"].to_numpy()] = counted[name].to_numpy()
    return table.reshape(len(GOALS), 2, BUCKETS)


def _shape(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Shape measures of each text, all near the unit interval; 0 for a text without words."""
    found = words_of(raw, offsets)
    n_words = found.per_doc()
    some, chars = np.maximum(n_words, 1), np.maximum(np.diff(offsets), 1)

    def share(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mark)))
        return (total[offsets[1:]] - total[offsets[:-1]]) / chars

    order = np.lexsort((found.hashes, found.doc))
    h, d = found.hashes[order], found.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    same = np.zeros(len(found.hashes), bool)
    same[1:] = (found.hashes[1:] == found.hashes[:-1]) & (found.doc[1:] == found.doc[:-1])
    length = np.bincount(found.doc, found.ends - found.starts, found.n_docs)
    columns = [
        np.log1p(n_words) / 10,
        np.bincount(d[new], minlength=found.n_docs) / some,
        np.minimum(length / some / 20, 3),
        share(_SYMBOL[raw]) * 10,
        share(_DIGIT[raw]) * 10,
        np.bincount(found.doc[same], minlength=found.n_docs) / some,
        share((raw >= 65) & (raw <= 90)) * 5,
    ]
    return np.stack(columns, 1)


def evidence(docs: DataFrame, table: np.ndarray, shares: list[float], skip=None) -> DataFrame:
    """``docs`` (doc_id, text, labels, host, path) without text, with evidence for each goal.

    The counts that a labelled document is judged by leave out its own. Rows whose ``hashed``
    the bit map ``skip`` may hold are left out.
    """
    held = docs.sparkSession.sparkContext.broadcast(table)
    keep = [c for c in docs.columns if c not in ("text", "hashed")]
    names = [*SHAPE, *(f"{g}_{side}_{e}" for g in GOALS for side in ("no", "yes") for e in EVIDENCE)]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if skip is not None:
                stay = ~shared.may_hold(skip, batch.column("hashed").to_numpy())
                batch = batch.take(pa.array(np.flatnonzero(stay)))
            text = batch.column("text")
            goals = [
                batch.column(g).fill_null(-1).to_numpy(zero_copy_only=False) for g in GOALS
            ]
            rest = batch.select(keep)
            for low, high, raw, offsets in text_slices(text):
                n = high - low
                columns = list(_shape(raw, offsets).T)
                bucket, doc = _distinct(raw, offsets)
                for g in range(len(GOALS)):
                    own = goals[g][low:high][doc]
                    no, yes = (held.value[g][v][bucket] - (own == v) for v in (0, 1))
                    seen = no + yes + WORD_STRENGTH
                    for part, share in ((no, 1 - shares[g]), (yes, shares[g])):
                        ratio = np.log((part + WORD_STRENGTH * share) / seen / share)
                        most = np.zeros(n)
                        np.maximum.at(most, doc, ratio)
                        strong = np.maximum(ratio - TELLING, 0)
                        columns += [most, np.log1p(np.bincount(doc, strong, n))]
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(low, n).columns, *(pa.array(c, pa.float64()) for c in columns)],
                    [*keep, *names],
                )

    kinds = [f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += [f"{c} double" for c in names]
    return docs.mapInArrow(measure, ", ".join(kinds))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


@dataclass
class Sites:
    """Labels of paths and hosts, and how many labels the prior of either is worth.

    ``paths`` has host, path, path_n, path_k (labels, and those that are 1), ``hosts`` has host,
    host_n and host_k.
    """

    paths: DataFrame
    hosts: DataFrame
    overall: float
    host_strength: float
    path_strength: float

    def odds(self, label: Column) -> Column:
        """Log odds over the whole corpus, from the counts of a row's sites; 0 for unknown ones.

        A row with a label is left out of the counts that it is judged by.
        """
        own = F.when(label.isNotNull(), 1).otherwise(0)
        yes = F.coalesce(label, F.lit(0))
        n, k = ({c: F.coalesce(F.col(f"{c}_{x}"), own if x == "n" else yes) for c in ("host", "path")} for x in "nk")
        host = (k["host"] - yes + self.host_strength * self.overall) / (
            n["host"] - own + self.host_strength
        )
        path = (k["path"] - yes + self.path_strength * host) / (
            n["path"] - own + self.path_strength
        )
        return _logit(path) - float(np.log(self.overall / (1 - self.overall)))


def shrunk_shares(labelled: DataFrame, goal: str) -> Sites:
    """Counts of ``labelled`` (host, path, goal) by site, and the strengths of the priors.

    A site's strength of prior follows from the spread of the shares of sites of its level: the
    method of moments for a beta distribution, over sites weighted by their labels.
    """
    per_path = shared.stored(
        labelled.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("path_n"), F.sum(goal).alias("path_k")
        ),
        "paths",
    )
    per_host = shared.stored(
        per_path.groupBy("host").agg(
            F.sum("path_n").alias("host_n"), F.sum("path_k").alias("host_k")
        ),
        "hosts",
    )

    def strength(sites: DataFrame, of: str, centre: Column) -> float:
        n, k = F.col(f"{of}_n"), F.col(f"{of}_k")
        spread, chance, weighted = sites.agg(
            F.sum(n * (k / n - centre) ** 2),
            F.sum(centre * (1 - centre)),
            F.sum(n * centre * (1 - centre)),
        ).first()
        # Beyond the binomial variance, the sum grows by the variance between sites times labels.
        extra = (spread or 0.0) - (chance or 0.0)
        return max(1.0, weighted / extra if extra > 1e-9 else 1e6)

    total, yes = per_host.agg(F.sum("host_n"), F.sum("host_k")).first()
    overall = min(max(yes / total if total else 0.5, 1e-3), 1 - 1e-3)
    hosts = strength(per_host, "host", F.lit(overall))
    share = (F.col("host_k") + hosts * overall) / (F.col("host_n") + hosts)
    centred = per_host.select(F.col("host").alias("of"), share.alias("centre"))
    joined = per_path.join(centred, per_path["host"].eqNullSafe(centred["of"]))
    return Sites(per_path, per_host, overall, hosts, strength(joined, "path", F.col("centre")))


def _with_site_counts(docs: DataFrame, sites: Sites) -> DataFrame:
    """Join the counts of a row's path and host; null is a host, but no path.

    Site tables are small beside documents; a hot host's documents are split over salts.
    """
    salts = 16
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("s")
    by_path = sites.paths.select(
        F.col("host").alias("h"), F.col("path").alias("p"), "path_n", "path_k", spread
    )
    by_host = sites.hosts.select(F.col("host").alias("h"), "host_n", "host_k", spread)
    docs = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    same = docs["host"].eqNullSafe(by_path["h"]) & (docs["path"] == by_path["p"])
    docs = docs.join(by_path, same & (docs["salt"] == by_path["s"]), "left").drop("h", "p", "s")
    same = docs["host"].eqNullSafe(by_host["h"]) & (docs["salt"] == by_host["s"])
    return docs.join(by_host, same, "left").drop("h", "s", "salt")


def _picked(rows: DataFrame, bits) -> DataFrame:
    """The rows whose ``hashed`` the bit map may hold."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            use = np.flatnonzero(shared.may_hold(bits, batch.column("hashed").to_numpy()))
            yield batch.take(pa.array(use))

    return rows.mapInArrow(pick, rows.schema)


def assess(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, quality, toxic, kept`` for every row of ``docs`` (doc_id, text, host, path).

    ``labels`` has doc_id, quality and toxic, each 0, 1 or null; of repeated labels the largest
    holds. ``quality`` and ``toxic`` are probabilities; kept are documents of at least ``least``
    quality and less than ``least`` toxicity. A null text is empty and judged by its shape and
    site. A labelled row is judged without its own label, in the counts of words as of sites. A
    row without doc_id has no label; null is a host like others. Without any labels of a goal, or of one value only,
    its probability is that value's, or 0.5. Other columns are not looked at.
    """
    spark = docs.sparkSession
    shared.ship(spark)
    marks = (
        labels.filter("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(*[F.max(F.col(g).cast("int")).alias(g) for g in GOALS])
    )
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("host").cast("string"),
        F.col("path").cast("string"),
    )
    # Texts are shuffled only if their ids may be labelled; all others are judged where they lie.
    rows = rows.withColumn("hashed", F.xxhash64("doc_id"))
    marks = shared.stored(marks, "marks")
    bits = shared.bit_filter(marks, F.xxhash64("labelled_id"))
    # Merged at every size: whether few labels are broadcast would decide how disk use grows.
    marks = marks.hint("merge")
    marked = _picked(rows, bits).join(marks, F.col("doc_id") == F.col("labelled_id"), "left")
    marked = shared.stored(marked.drop("labelled_id", "hashed"), "marked")
    labelled = marked.filter("quality is not null or toxic is not null")
    table = _word_table(labelled)
    counts = labelled.agg(*[F.avg(F.col(g).cast("double")) for g in GOALS]).first()
    shares = [min(max(c if c is not None else 0.5, 1e-3), 1 - 1e-3) for c in counts]
    rest = rows.withColumns({g: F.lit(None).cast("int") for g in GOALS})
    judged = evidence(marked, table, shares).unionByName(evidence(rest, table, shares, bits))
    scored = shared.stored(judged, "evidence")
    for goal, average in zip(GOALS, counts):
        scored = _predicted(scored, goal, average)
    good = (F.col("quality_p") >= least) & (F.col("toxic_p") < least)
    return scored.select(
        "doc_id",
        F.round("quality_p", 9).alias("quality"),
        F.round("toxic_p", 9).alias("toxic"),
        good.alias("kept"),
    )


def _predicted(scored: DataFrame, goal: str, average: float | None) -> DataFrame:
    """``scored`` with the probability of a goal: classifier odds plus the site's."""
    out = f"{goal}_p"
    if average is None or average in (0.0, 1.0):
        return scored.withColumn(out, F.lit(0.5 if average is None else float(average)))
    features = [*SHAPE, *(f"{goal}_{side}_{e}" for side in ("no", "yes") for e in EVIDENCE)]
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(scored)
    known = vectors.filter(F.col(goal).isNotNull())
    model = LogisticRegression(labelCol=goal, regParam=1e-4, maxIter=50).fit(known)
    sites = shrunk_shares(known, goal)
    judged = model.transform(vectors).withColumn("own", vector_to_array("rawPrediction")[1])
    judged = judged.drop("features", "rawPrediction", "probability", "prediction")
    judged = _with_site_counts(judged, sites).withColumn("site", sites.odds(F.col(goal)))
    judged = judged.drop("path_n", "path_k", "host_n", "host_k")
    p = 1 / (1 + F.exp(-(F.col("own") + F.col("site"))))
    return judged.withColumn(out, p).drop("own", "site")
