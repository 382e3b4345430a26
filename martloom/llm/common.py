"""Helpers shared by the training-data operators: batched text maps, worker set-up, connected components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martloom.session import materialise

#: Bytes of text that a Python step handles at once: bounds a worker's memory whatever the batch size.
SLICE_BYTES = 4 << 20

Columns = dict[str, list]


def on_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver found it."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return on_workers(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows that hold about SLICE_BYTES of text; a longer single text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 64
    if start < batch.num_rows:
        yield batch.slice(start)


def numbered(df: DataFrame) -> DataFrame:
    """The columns named c0, c1 and so on: whatever their own names, with dots or like those of an operator's columns, they meet none of its."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def map_texts(df: DataFrame, text: str, schema: str, make: Callable[[], Callable[[Columns], Columns]]) -> DataFrame:
    """Arrow-batched map. ``make`` runs once in each task and returns the step from columns to columns."""
    on_workers(df.sparkSession)
    fields = T.StructType.fromDDL(schema)

    def run(batches):
        step, arrow = make(), to_arrow_schema(fields)
        for batch in batches:
            for part in slices(batch, text):
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def remainder(doc_id: str, parts: int):
    """Fold of a document: crc32 of the id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """Connected components of undirected edges (a, b) as (node, component): the smallest node reachable.

    Alternating star contraction: every node points its larger neighbours, then its smaller ones,
    at the smallest it knows. Each step is an aggregate by node, combined on the map side, and a join
    whose hot keys AQE splits; steps are written to the shared folder. Edges without a node are ignored.
    """
    links = materialise(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links",
    )
    for _ in range(most):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select("a", F.col("low").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("low").alias("b")))
        after = materialise(small.where("a <> b").distinct(), "links")
        # A star forest is a fixed point: no node is both a leaf and a centre, and each leaf has one centre.
        leaves = after.groupBy("a").agg(F.count("*").alias("n"))
        unsettled = leaves.where("n > 1").select("a").unionByName(
            after.select(F.col("b").alias("a")).distinct().join(leaves, "a", "left_semi"))
        links = after
        if unsettled.isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    centres = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        centres.select("node", F.col("node").alias("component")))
