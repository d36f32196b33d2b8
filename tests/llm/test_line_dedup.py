import glob

import pyarrow.parquet as pq

from ratingloom.llm import line_dedup, shared

from .conftest import by_id, docs_frame

LINE = "this line is long enough to count as one that documents share"


def test_largest_id_keeps_its_lines(spark):
    rows = [(i, f"first {i}\n \t{LINE.upper()} \r\nshort\n\n{LINE}", "en", "a", 0) for i in range(5)]
    rows += [(9, "short\nother", "en", "a", 0), (10, None, "en", "a", None)]
    got = by_id(line_dedup.dedup_lines(docs_frame(spark, rows)))
    for i in range(4):
        assert (got[i][0].n_lines, got[i][0].n_dropped) == (5, 2)
        assert got[i][0].kept_text == f"first {i}\nshort\n"
    assert got[4][0].kept_text == rows[4][1] and got[4][0].n_dropped == 0
    assert (got[10][0].n_lines, got[10][0].kept_text) == (1, "")
    stage = by_id(line_dedup.without_repeated_lines(docs_frame(spark, rows)))
    assert stage[10][0].text is None and stage[0][0].n_chars == len("first 0\nshort\n")


def test_four_documents_are_too_few_and_rows_of_one_id_are_one(spark):
    rows = [(i, LINE, "en", "a", 0) for i in (1, 2, 3, 4, 4, 4)]
    got = by_id(line_dedup.dedup_lines(docs_frame(spark, rows)))
    assert all(r.n_dropped == 0 for rs in got.values() for r in rs) and len(got[4]) == 3
    more = docs_frame(spark, [*rows, (None, LINE, "en", "a", 0)])
    got = by_id(line_dedup.dedup_lines(more))
    assert [r.n_dropped for r in got[4]] == [0, 0, 0] and got[None][0].n_dropped == 1
    assert got[1][0].kept_text == ""


def _batch(spark, b):
    rows = [(b * 3 + i, f"{LINE} {i % 2}\n{LINE} only {b}", "en", "a", 0) for i in range(3)]
    return line_dedup.line_hashes(docs_frame(spark, rows))


def _content(runs):
    return sorted((bytes(r.line), r.n_docs, r.keeper) for r in runs.totals().collect())


def test_runs_are_compacted_and_add_up(spark):
    runs = line_dedup.LineRuns(spark, shared.new_path(spark, "test-runs"))
    for b in range(10):
        runs.add(_batch(spark, b))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sorted(r.keeper for r in runs.frequent(5).collect()) == [28, 29]
    assert sorted((n, keeper) for _, n, keeper in _content(runs))[-2:] == [(10, 28), (20, 29)]


def test_later_session_goes_on_from_the_folder(spark):
    """Two sessions on one folder give what one session gives."""
    one = line_dedup.LineRuns(spark, shared.new_path(spark, "test-runs"))
    first = line_dedup.LineRuns(spark, shared.new_path(spark, "test-runs"))
    for b in range(5):
        one.add(_batch(spark, b))
        first.add(_batch(spark, b))
    later = spark.newSession()
    second = line_dedup.LineRuns.open(later, first.folder)
    assert (second.levels, second.version) == (first.levels, first.version)
    for b in range(5, 8):
        one.add(_batch(spark, b))
        second.add(_batch(later, b))
    assert _content(second) == _content(one)
    assert [len(level) for level in second.levels] == [len(level) for level in one.levels]


def test_a_batch_joins_the_runs(spark):
    """A run holds totals: new lines with their own counts, known ones with all so far."""
    runs = line_dedup.LineRuns(spark, shared.new_path(spark, "test-runs"))
    runs.add(_batch(spark, 0))
    runs.add(_batch(spark, 1))
    newest = spark.read.parquet(f"{runs.folder}/{runs.levels[0][1]}")
    assert sorted((r.n_docs, r.keeper) for r in newest.collect()) == [(2, 4), (3, 5), (4, 5)]
    files = sorted(glob.glob(f"{runs.folder}/{runs.levels[0][1]}/part-*.parquet"))
    lines = [line for f in files for line in pq.read_table(f)["line"].to_pylist()]
    assert len(lines) == 3 and lines == sorted(lines)


def test_batches_do_not_matter(small):
    one = sorted(map(tuple, line_dedup.dedup_lines(small, batches=1).collect()))
    assert sorted(map(tuple, line_dedup.dedup_lines(small, batches=5).collect())) == one


def test_odd_rows_and_empty(odd, none):
    got = line_dedup.dedup_lines(odd)
    assert got.count() == odd.count()
    texts = {(r.doc_id, r.text or "") for r in odd.collect()}
    assert {(r.doc_id, r.kept_text) for r in got.collect()} == texts
    assert line_dedup.without_repeated_lines(odd).columns == odd.columns
    assert line_dedup.dedup_lines(none).isEmpty()
    assert line_dedup.without_repeated_lines(none).isEmpty()


def test_shared_folder_is_the_sessions(spark):
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
