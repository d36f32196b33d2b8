"""Feature columns for rating prediction, and the train / test split.

Per-key statistics come from one aggregation of counts per key and rating value. It runs inside
the map tasks and yields mode, mean and row count together.
"""

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingloom.operators.genres import genre_onehot
from ratingloom.plans.hot_keys import HOT_ROWS, KeyStats, attach

_ROWS = "__rows"
_TOTAL, _RATED = "__total", "__rated"
_INDICATORS = "__indicators"


def _key_stats(
    ratings: DataFrame,
    key: str,
    value: str,
    mode: str | None,
    mean: str | None,
    sums: bool = False,
) -> DataFrame:
    """One row per key: most frequent value (smallest on ties), mean, and number of rows.

    With ``sums``, also the sum and the number of ratings that the mean is made of.
    """
    per_value = ratings.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    present = F.col(value).isNotNull()
    columns = [F.sum("n").alias(_ROWS)]
    if mode:
        rated = present & ~F.isnan(value)
        best = F.min(F.when(rated, F.struct(-F.col("n"), F.col(value))))
        columns.append(best[value].alias(mode))
    if mean:
        total = F.sum(F.col("n") * F.col(value))
        rated_rows = F.sum(F.when(present, F.col("n")))
        columns.append(F.try_divide(total, rated_rows).alias(mean))
        if sums:
            columns += [total.alias(mean + _TOTAL), rated_rows.alias(mean + _RATED)]
    return per_value.groupBy(key).agg(*columns)


def _without_own(mean: str, value: str) -> Column:
    """The mean of a key's other ratings; NULL if it has none."""
    own = F.col(value).isNotNull()
    total = F.col(mean + _TOTAL) - F.when(own, F.col(value)).otherwise(0)
    return F.try_divide(total, F.col(mean + _RATED) - own.cast("int"))


def _features(
    ratings: DataFrame,
    fit_on: DataFrame | None,
    modes: bool,
    means: bool,
    user: str,
    item: str,
    value: str,
    hot_rows: int,
    onehot: DataFrame | None = None,
    leave_one_out: bool = False,
    absent: Column | None = None,
) -> DataFrame:
    """Both keys' statistics and the indicators on every rating, in one pass over the ratings.

    With ``fit_on`` or ``leave_one_out``, a key without ratings gets the global mean. The indicators
    of an item that ``onehot`` lacks are ``absent``, by default 0.
    """
    source = ratings if fit_on is None else fit_on
    names = {
        item: ("mode_movie" if modes else None, "movie_average" if means else None),
        user: ("mode_user" if modes else None, "user_average" if means else None),
    }
    stats = {
        key: _key_stats(source, key, value, *names[key], sums=leave_one_out)
        for key in (item, user)
    }
    indicators: list[str] = []
    if onehot is not None:
        indicators = [c for c in onehot.columns if c != item]
        known = onehot.filter(F.col(item).isNotNull())
        how = "left" if fit_on is None else "full"
        stats[item] = stats[item].filter(F.col(item).isNotNull()).join(known, item, how)
    wanted = [c for pair in zip(*[names[key] for key in (item, user)]) for c in pair if c]
    keys = []
    for key in (item, user):
        sizes = None
        if fit_on is not None:
            sizes = ratings.groupBy(key).agg(F.count(F.lit(1)).alias(_ROWS))
        keys.append(KeyStats(key, stats[key], _ROWS, sizes))
    joined = attach(ratings.select(item, user, value), keys, hot_rows)
    if leave_one_out:
        joined = joined.withColumns(
            {c: _without_own(c, value) for c in ("movie_average", "user_average")}
        )
    if fit_on is not None or leave_one_out:
        typical = source.agg(F.avg(value)).scalar()
        joined = joined.withColumns({c: F.coalesce(F.col(c), typical) for c in wanted})
    if indicators and absent is None:
        joined = joined.fillna(0, indicators)
    elif indicators:
        joined = joined.withColumns({c: F.coalesce(F.col(c), absent) for c in indicators})
    return joined.select(item, user, value, *wanted, *indicators)


def mode_features(
    ratings: DataFrame,
    fit_on: DataFrame | None = None,
    *,
    user: str = "userId",
    item: str = "movieId",
    value: str = "rating",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every rating with the most frequent rating of its item and of its user.

    With ``fit_on`` the modes come from that table only (the training part), and a key it lacks
    gets its mean rating.
    """
    return _features(ratings, fit_on, True, False, user, item, value, hot_rows)


def avg_features(
    ratings: DataFrame,
    fit_on: DataFrame | None = None,
    *,
    user: str = "userId",
    item: str = "movieId",
    value: str = "rating",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every rating with the mean rating of its item and of its user; ``fit_on`` as above."""
    return _features(ratings, fit_on, False, True, user, item, value, hot_rows)


def rating_features(
    ratings: DataFrame,
    items: DataFrame,
    vocabulary: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
    *,
    user: str = "userId",
    item: str = "movieId",
    value: str = "rating",
    genres: str = "genres",
    hot_rows: int = HOT_ROWS,
    leave_one_out: bool = False,
) -> DataFrame:
    """Item, user and rating, followed by the features: two modes, two means, genre indicators.

    ``leave_one_out`` takes each rating out of its own means, as training rows need: a rating that
    is to be predicted is not part of its means either.

    Indicators join the item statistics first, one row per item, so rating rows are joined once
    per key whatever the number of features. Name the genres in ``vocabulary`` to spare the job
    that lists them.
    """
    onehot = genre_onehot(items, vocabulary, item=item, genres=genres)
    return _features(
        ratings, fit_on, True, True, user, item, value, hot_rows, onehot, leave_one_out
    )


def feature_vectors(
    features: DataFrame,
    *,
    user: str = "userId",
    item: str = "movieId",
    value: str = "rating",
) -> DataFrame:
    """Assemble all columns but item, user and rating into a vector column ``features``."""
    inputs = [c for c in features.columns if c not in (item, user, value)]
    return VectorAssembler(inputCols=inputs, outputCol="features").transform(features)


def rating_vectors(
    ratings: DataFrame,
    items: DataFrame,
    vocabulary: Sequence[str] | None = None,
    fit_on: DataFrame | None = None,
    *,
    user: str = "userId",
    item: str = "movieId",
    value: str = "rating",
    genres: str = "genres",
    hot_rows: int = HOT_ROWS,
    leave_one_out: bool = False,
) -> DataFrame:
    """Item, user, rating and the ``feature_vectors`` of ``rating_features``.

    The indicators become one vector per item before they meet the ratings, so a rating carries
    five values through joins and assembly whatever the number of genres.
    """
    onehot = genre_onehot(items, vocabulary, item=item, genres=genres)
    names = [c for c in onehot.columns if c != item]
    absent = None
    if names:
        packed = VectorAssembler(inputCols=names, outputCol=_INDICATORS).transform(onehot)
        onehot = packed.select(item, _INDICATORS)
        absent = array_to_vector(F.array(*[F.lit(0.0)] * len(names)))
    flat = _features(
        ratings, fit_on, True, True, user, item, value, hot_rows, onehot, leave_one_out, absent
    )
    if names:  # joins lose the size, which the assembler would otherwise read from a first row
        flat = VectorSizeHint(
            inputCol=_INDICATORS, size=len(names), handleInvalid="optimistic"
        ).transform(flat)
    return feature_vectors(flat, user=user, item=item, value=value).select(
        item, user, value, "features"
    )


def row_share(df: DataFrame, seed: int = 42) -> Column:
    """A number in [0, 1) that depends on the row's values and the seed only.

    It is the first 48 bits of an MD5 digest, so other engines can compute it.
    """
    parts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(2.0**48)


def random_split(
    ratings: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int = 42
) -> list[DataFrame]:
    """Seeded random parts of the given weights.

    A digest of the row decides, so parts are disjoint and complete however often and in whatever
    partitions they are computed; equal rows go to the same part. No sort and no shuffle.
    """
    total, low, parts = float(sum(weights)), 0.0, []
    share = row_share(ratings, seed)
    for n, weight in enumerate(weights, 1):
        high = low + weight / total
        upto = F.lit(True) if n == len(weights) else share < high
        parts.append(ratings.filter((share >= low) & upto))
        low = high
    return parts


def train_test_split(
    ratings: DataFrame,
    train_tenths: int = 7,
    *,
    user: str = "userId",
    item: str = "movieId",
    ts: str = "timestamp",
) -> DataFrame:
    """Every rating with ``is_train``, decided by its user, item and day.

    A digest of the three is cut into tenths, so ids in steps and days of mass loading do no harm.
    No shuffle and no sort, and a recomputed partition always splits the same way.
    """
    day = F.floor(F.col(ts) / 86400)
    share = row_share(ratings.select(user, item, day.alias("day")), 0)
    named = ratings.withColumn("day", day)
    return named.withColumn("is_train", share < train_tenths / 10).drop("day")
