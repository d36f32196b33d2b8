"""Tag relevance and tag usage."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tag_relevance(
    scores: DataFrame,
    tag_names: DataFrame,
    k: int = 20,
    digits: int = 9,
    *,
    tag_id: str = "tagId",
    tag: str = "tag",
    relevance: str = "relevance",
) -> DataFrame:
    """The ``k`` named tags with the highest mean relevance, rounded, so that sums of inexact
    decimals in another order rank alike."""
    mean = scores.groupBy(tag_id).agg(F.round(F.avg(relevance), digits).alias("avg_relevance"))
    return (
        mean.join(tag_names.select(tag_id, tag), tag_id)
        .orderBy(F.col("avg_relevance").desc(), tag, tag_id)
        .limit(k)
        .select(tag, "avg_relevance")
    )


def top_tags(tags: DataFrame, k: int = 20, *, tag: str = "tag") -> DataFrame:
    """The ``k`` most used tags."""
    return (
        tags.groupBy(tag)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.col("count").desc(), tag)
        .limit(k)
    )
