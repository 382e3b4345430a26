"""Table writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.columns import between_dates
from martloom.sources.buckets import MAX_ROWS, BucketTable

def write_mart(df: DataFrame, path: str) -> None:
    """Replace a mart: snappy Parquet."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "snappy").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``. The rebalance step gives every partition files of
    like size and, under AQE, splits a partition that holds most of the rows."""
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        .partitionBy(*by).parquet(path)
    )


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace all rows of a staging table."""
    write_mart(df, path)


def clustered_table(
    df: DataFrame, path: str, partition_by: str | None, sort_by: Sequence[str], cluster_by: Sequence[str] = ()
) -> None:
    """Files laid out by a clustering key and sorted inside, for pruning by partition and by row group."""
    by = [F.col(c) for c in ([partition_by] if partition_by else []) + list(cluster_by)]
    laid = df.hint("rebalance", *by) if by else df.hint("rebalance")
    inside = ([partition_by] if partition_by else []) + list(sort_by)
    writer = laid.sortWithinPartitions(*inside).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def bucketed_table(df: DataFrame, table: str, key: str, buckets: int, sort_by: Sequence[str]) -> None:
    """Catalog table bucketed by ``key``: joins and groupings on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(*sort_by).saveAsTable(table)


def sample_to_lake(
    events: DataFrame, path: str, date_from: str, date_to: str, fraction: float = 0.1, seed: int = 42
) -> None:
    """Bernoulli sample of a date range, partitioned by date; seeded so it can be repeated."""
    write_partitioned(between_dates(events, "date", date_from, date_to).sample(fraction, seed), path, ["date"])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Table at ``path``, or an empty one of the schema before its first load."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
    schema: T.StructType,
    max_rows: int = MAX_ROWS,
) -> None:
    """Merge a batch into a table of buckets, rewriting only the buckets the batch touches, in one commit.

    ``merge(target, source)`` is one of the plans of ``operators.merge``. Buckets split as the table grows, so a batch of few
    keys rewrites few buckets of bounded size; null keys are refused.
    """
    BucketTable(spark, path, schema, keys, max_rows, filters=False).merge(source, merge)


def read_merged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table written by ``merge_into``, by default with the columns it was written with."""
    if schema is None:
        schema = BucketTable(spark, path, T.StructType(), []).columns()
    return BucketTable(spark, path, schema, []).read()


#: Beside the batches; the leading underscore keeps it out of reads of the table.
_LEDGER = "_ledger"


def run_of(spark: SparkSession) -> str:
    """The streaming query whose micro-batch this thread is in: its id stays over restarts from its checkpoint, and a fresh checkpoint gets another."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def write_batch(df: DataFrame, path: str, batch_id: int, run: str | None = None) -> None:
    """Append one micro-batch of a run as its own partition, and then enter it into the ledger.

    Replaying the batch replaces that partition, a run from a fresh checkpoint has partitions of its own, and a batch that was
    cut off before its entry is not read.
    """
    spark = df.sparkSession
    run = run or run_of(spark)

    def write(rows: DataFrame, to: str) -> None:
        named = rows.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("long")})
        # Messages of one batch are much alike, which zstd finds over a whole page.
        named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("run_id", "batch_id").parquet(to)

    write(df, path)
    write(spark.range(1).coalesce(1).select(F.current_timestamp().alias("entered_at")), f"{path}/{_LEDGER}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(entered_at, run_id, batch_id) of every batch that is there as a whole."""
    return read_or_empty(spark, f"{path}/{_LEDGER}", "entered_at timestamp, run_id string, batch_id long")


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All micro-batches that the ledger has."""
    stored = T.StructType([*schema.fields, T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())])
    entered = read_ledger(spark, path).select("run_id", "batch_id")
    return read_or_empty(spark, path, stored).join(entered, ["run_id", "batch_id"], "left_semi").drop("run_id", "batch_id")
