"""A training corpus from the documents table, stage by stage.

Language identification, near-duplicate removal, benchmark decontamination, secret
redaction, packing.  Each stage works on all that the one before it kept, and all but the last return
the columns of documents.  A stage's result is written as Parquet to shared storage and read again, so
a lost executor costs no finished stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm.decontamination import contaminated
from tallymill.llm.jaccard import jaccard_classes
from tallymill.llm.language import UNDETERMINED, identify
from tallymill.llm.packing import pack_documents
from tallymill.llm.secrets import scan_secrets
from tallymill.llm.spread import shared, ship, stage, table
from tallymill.sinks.writers import shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _set_aside(docs: DataFrame, names: set[str]) -> tuple[DataFrame, dict[str, str]]:
    """Rename columns that an operator would replace; the second value renames them back."""
    back = {f"_aside_{c}": c for c in docs.columns if c in names}
    return docs.withColumnsRenamed({c: a for a, c in back.items()}), back


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told: a null text, or one without a letter, goes, and no other, labels or not."""
    ship(spark)
    apart, back = _set_aside(docs, {"lang_pred", "score"})
    labelled = docs.select("text", "lang")
    if labelled.where("lang IS NOT NULL AND text <> ''").isEmpty():
        labelled = docs.select("text", F.lit("any").alias("lang"))  # nothing to tell apart: every letter is of one language
    found = identify(apart, labelled)
    return found.where(F.col("lang_pred") != UNDETERMINED).drop("lang_pred", "score").withColumnsRenamed(back)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A stored copy with a number per row, and its name: rows without an id, or with one in common, are told apart by it."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), shared(docs), "numbered", "zstd"), name


def _rows_as_documents(rows: DataFrame, row: str) -> DataFrame:
    return rows.select(F.col(row).alias("doc_id"), "text")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates one row: that of the smallest id, null last, of several such rows any one."""
    ship(spark)
    rows, row = _numbered(docs)
    classes = jaccard_classes(_rows_as_documents(rows, row)).select(F.col("doc_id").alias(row), "class_id")
    first = F.min_by(row, F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(row)))
    kept = rows.select(row, "doc_id").join(classes, row).groupBy("class_id").agg(first.alias(row))
    return rows.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item of five words or more, whether they have an id or not."""
    ship(spark)
    rows, row = _numbered(docs)
    found = contaminated(_rows_as_documents(rows, row), table(spark, sf_dir, "benchmark"))
    found = found.select(F.col("doc_id").alias(row)).distinct()
    return rows.join(found, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the scan finds, but endpoints, replaced by its kind in brackets."""
    ship(spark)
    added = {"n_assign", "n_access", "n_hex", "base_spans", "spans", "clean"}
    apart, back = _set_aside(docs, added)
    found = scan_secrets(apart)
    changed = F.col("clean") != F.col("text")
    cells = {"text": F.when(changed, F.col("clean")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        cells["n_chars"] = F.when(changed, F.length("clean").cast("long")).otherwise(F.col("n_chars"))
    redacted = found.withColumns(cells).drop(*added).withColumnsRenamed(back)
    return redacted.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences."""
    ship(spark)
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# Language identification and packing cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark)
    for k, (name, apply) in enumerate(STAGES):
        docs = apply(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stage(docs, folder, name)
    return docs
