"""The corpus pipeline: quality rules, near-duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and reread as the next stage's docs.  All but the last return the
columns of documents, extra columns included, whatever their names.

In every stage a null text counts as empty, repeated rows are rows of their own
(near-duplicates keep one of them), a null doc_id is an id like any other and
ties go to the smaller doc_id; an empty table gives an empty one; texts of any
length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, packing, quality, secret_scan, simhash
from tessera.llm.common import stored, table


def _with_text(scored: DataFrame, text: Column) -> DataFrame:
    """The input rows (column ``row``) with a new text, and n_chars where the text changed."""
    out = scored.select("row", text.alias("text"))  # two names only, so no column of the input clashes
    changed = ~F.col("text").eqNullSafe(F.col("row.text"))

    def field(name: str) -> Column:
        own = F.col("row")[name]
        if name == "text":
            return F.col("text")
        return (F.when(changed, F.length("text").cast("long")).otherwise(own) if name == "n_chars" else own).alias(name)

    return out.select(*(field(name) for name in scored.schema["row"].dataType.names))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; failing lines of kept ones go."""
    return _with_text(quality.quality_rules(docs, whole_row=True).where("kept"), F.col("cleaned_text"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest doc_id."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is replaced by a mark; no document goes."""
    return _with_text(secret_scan.secret_scan(docs, whole_row=True), secret_scan.redact())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of what is left."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("best_fit_packing", packing_stage),
]

#: Fingerprint links, suffix search and tokenizing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
