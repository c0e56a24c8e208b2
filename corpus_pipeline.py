"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before
kept; what it returns is written and read again before the next. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import read_table, written
from quarry.llm.encoding import public_path
from quarry.llm.jaccard import jaccard_components
from quarry.llm.lines import dedup_lines
from quarry.llm.mixing import mix_sources
from quarry.llm.packing import pack_documents
from quarry.llm.quality import score_quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return score_quality(docs).where("keep").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that 10 or more of them have. A
    document may end up empty; it stays a row."""
    out = dedup_lines(docs, min_docs=10, min_chars=1)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id."""
    gone = jaccard_components(docs, words=5).where(F.col("doc_id") != F.col("component_id")).select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, one or two rows each."""
    mixed = mix_sources(docs, (5, 2, 1), total_share=1.5, most_epochs=2.0, carry=docs.columns).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))) \
        .select(*[F.col(f"row_{c}").alias(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of 2048 tokens. A document that the
    mix took twice is packed twice."""
    return pack_documents(docs, public_path(), capacity=2048, end_id=0)


STAGES = [("quality classifier", quality_classifier), ("line dedup", line_dedup), ("n-gram Jaccard join", ngram_jaccard_join),
          ("mixing sources", source_mixing), ("best-fit packing", best_fit_packing)]

#: The classifier is trained, which SQL can't express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k + 1}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
