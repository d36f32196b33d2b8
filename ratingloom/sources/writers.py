"""Result writers."""

from pyspark.sql import DataFrame


def write_csv(
    df: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False
) -> None:
    """Write a headed UTF-8 CSV.

    ``single_file`` writes everything in one task, after the work is done in as many as it takes.
    Use it for reports whose size is fixed by the operator (top-k, per-genre, per-decade), never
    for rating-level results.
    """
    if single_file:
        df = df.repartition(1)
    (
        df.write.mode(mode)
        .options(header=True, encoding="UTF-8", quote='"', escape='"')
        .csv(path)
    )


def write_parquet(
    df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None
) -> None:
    """Write Parquet, the format to keep large tables in (column pruning, filter pushdown)."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
