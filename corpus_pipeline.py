"""A training corpus from raw documents: quality, exact and near duplicates, tests, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last keep the
columns of ``documents``. ``run`` writes each stage's rows and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from railcadence.llm import aho, content_sort, linecrf, packing, partenum, queries
from railcadence.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model doesn't reject."""
    model = queries.quality_model(spark, docs, sf_dir)
    return linecrf.scored(docs, model, into="quality score").where("`quality score` >= 0.5").select(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of repeated rows one."""
    kept = content_sort.content_groups(docs).where("kept").select(
        F.col("id").alias("kept id"), F.col("digest").alias("kept digest")
    )
    digest = F.sha2(content_sort.normalised(F.col("text")), 256)
    rows = docs.join(kept, F.col("doc_id").eqNullSafe(F.col("kept id")) & (digest == F.col("kept digest")))
    same = Window.partitionBy("kept id", "kept digest").orderBy(F.length("text").desc())
    return rows.withColumn("kept row", F.row_number().over(same)).where("`kept row` = 1").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar texts."""
    return partenum.one_of_each(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a test item."""
    hits = aho.contamination(docs, table(spark, sf_dir, "benchmark"), into="test hits")
    return hits.where("`test hits`.n_hit = 0").select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    rows = packing.pack_documents(docs, *queries.tokenizer())
    return rows.withColumnRenamed("id", "doc_id")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality), ("exact dedup", exact_duplicates), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("packing", packed),
]

#: The classifier, the similarity join and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
