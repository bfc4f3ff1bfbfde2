"""Documents through the stages of a training-data pipeline: each stage's rows are written and read again as the next one's input.

Every stage judges rows, not ids: rows that share a doc_id, or have none, are judged each by its own text, and of
repeated rows the near-duplicate stage keeps one, as of all near duplicates. Defined for all stages: an empty table
gives no rows; a null or blank text is rejected by the quality rules and is otherwise no near copy, clean, without
personal data and without tokens; a very long text is worked on whole; columns beyond those of documents pass,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import scratch, stored, table
from chatloom.llm.decontamination import find_items
from chatloom.llm.jaccard_join import jaccard_classes
from chatloom.llm.pii import mask_pii
from chatloom.llm.quality import quality_rules
from chatloom.llm.sentencepieces import RESULT, encode
from chatloom.sources.scratch import passing


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't use."""
    while name in docs.columns:
        name += "_"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs, written once, with a number of its own for every row, and that column's name."""
    name = _free(docs, "_row")
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def _by_row(rows: DataFrame, row: str) -> DataFrame:
    """rows with their numbers in the place of doc_id, as the operators' input."""
    return rows.withColumn("doc_id", F.col(row)).drop(row)


def _without(rows: DataFrame, row: str, path: str) -> DataFrame:
    """rows but for those whose numbers the table in path lists."""
    listed = rows.sparkSession.read.schema(rows.select(row).schema).parquet(path)
    return rows.join(listed, row, "left_anti").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules don't reject; ties and repeated rows get equal verdicts, so a digest of what a verdict depends on names them."""
    told = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    digest = F.md5(F.concat_ws("|", told("doc_id"), told("lang"), told("text")))
    name, path = _free(docs, "_gone"), scratch(spark, "rejected")
    with passing(spark):
        gone = quality_rules(docs.withColumn("doc_id", digest)).where(~F.col("kept"))
        gone.select(F.col("doc_id").alias(name)).distinct().write.parquet(path)
    listed = spark.read.schema(f"`{name}` string").parquet(path)
    # A shuffle at every size: whether the list is short enough to broadcast must not change what the join costs.
    return docs.join(listed.hint("merge"), digest == F.col(name), "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of similar documents the row with the least doc_id, one of them where it is repeated; null ids come last."""
    rows, row = _numbered(docs)
    path = scratch(spark, "copies")
    with passing(spark):
        classes = jaccard_classes(_by_row(rows, row)).select(F.col("doc_id").alias(row), "class_id")
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("row"))
        placed = stored(rows.select("doc_id", row).join(classes, row), "classes-of-rows")
        first = placed.groupBy("class_id").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
        placed.join(first, "class_id").where(F.col(row) != F.col("first.row")).select(row).write.parquet(path)
    return _without(rows, row, path).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; an empty benchmark leaves all."""
    rows, row = _numbered(docs)
    path = scratch(spark, "contaminated")
    with passing(spark):
        gone = find_items(_by_row(rows, row), table(spark, sf_dir, "benchmark")).where(F.size("item_ids") > 0)
        gone.select(F.col("doc_id").alias(row)).write.parquet(path)
    return _without(rows, row, path).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and n_chars brought up to date."""
    return mask_pii(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens, token_ids and decodes_back in the place of text and of columns of those names."""
    return encode(docs, carried=[c for c in docs.columns if c != "text" and c not in RESULT])


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("pii", pii),
    ("sentencepiece", tokenize),
]

#: The near-duplicate, decontamination and tokenizing stages have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
