"""From raw documents to token ids: toxic documents go, one of each group of near duplicates stays, contaminated
documents go, secrets are masked, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet to the shared folder and
reads it again as the next stage's input. All stages but the last return the columns of ``documents``; what a stage removes or
masks is gone for the next. Rows are judged by their texts, so a null id is a document of its own in every stage and rows of a
repeated id are documents of their own; null text is empty text. Extra columns of the input are kept by all stages but the last,
whose own columns ``ids`` and ``n_tokens`` replace any of these names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import bpe, decontaminate, jaccard, secrets, toxicity
from martloom.llm.common import numbered, on_workers, table
from martloom.llm.queries import VOCABULARY
from martloom.session import materialise


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar, learned from the labels, does not reject."""
    on_workers(spark)
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group linked by Jaccard similarity: that of the smallest id, with or without an id judged by its text.

    Rows of a repeated id are judged apart, so unrelated texts under one id all stay."""
    on_workers(spark)
    return jaccard.first_rows(docs)


def contaminated_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in 20 lies in a benchmark window; decided by text, so with or without an id."""
    names, text = docs.columns, f"c{docs.columns.index('text')}"
    rows = numbered(docs)
    keyed = rows.withColumn("text_key", F.struct(F.xxhash64(text).alias("t1"), F.hash(text).alias("t2")))
    marked = decontaminate.contamination(keyed, table(spark, sf_dir, "benchmark"), key="text_key", text=text)
    bad = materialise(marked.where("contaminated").select("text_key").distinct(), "contaminated")
    return keyed.join(bad, "text_key", "left_anti").select(*rows.columns).toDF(*names)


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret replaced by a mask, and the number of characters counted again."""
    on_workers(spark)
    masked = secrets.redact(docs, secrets.train(docs))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast(kind)))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, ids): what a trainer reads."""
    on_workers(spark)
    return bpe.encode(docs, VOCABULARY, carry=[c for c in ("lang", "source") if c in docs.columns])


STAGES = [
    ("toxicity", toxic_out),
    ("near duplicates", near_duplicates_out),
    ("contamination", contaminated_out),
    ("secrets", secrets_masked),
    ("encoding", encoded),
]

#: No SQL: two stages apply learned models and one a tokenizer; tests hold run() against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
