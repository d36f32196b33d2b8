from ratingloom.operators.tags import tag_relevance, top_tags


def test_relevance_averages_per_id_and_needs_a_name(spark):
    scores = spark.createDataFrame(
        [(1, 1, 0.5), (2, 1, 1.0), (1, 2, 0.75), (1, 3, 1.0), (1, 4, 0.25)],
        "movieId int, tagId int, relevance double",
    )
    names = spark.createDataFrame([(1, "z"), (2, "a"), (4, "low")], "tagId int, tag string")
    rows = [tuple(r) for r in tag_relevance(scores, names, 2).collect()]
    assert rows == [("a", 0.75), ("z", 0.75)]


def test_top_tags_breaks_ties_by_name(spark):
    tags = spark.createDataFrame([(t,) for t in "ccbbaad"], "tag string")
    assert [tuple(r) for r in top_tags(tags, 2).collect()] == [("a", 2), ("b", 2)]
