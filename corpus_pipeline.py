"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``. All but the last keep the columns of the documents, under
whatever names and of whatever types others come with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import session
from framelake.llm import decontaminate, language, minhash, packing, secrets
from framelake.llm.words import free_name
from framelake.operators.joins import attach


def _as_they_were(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; those too far from any go, and so do texts
    that are null or have no letter."""
    session.ship_package(spark)
    mark = free_name(docs.columns, "_language")
    found = language.identify(docs, into=mark)
    return found.filter(f"NOT {mark}.rejected").select(*_as_they_were(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id.

    Documents without words belong to no group. Of rows that share an id, which are one
    document, one stays, the least as JSON; rows without an id all stay.
    """
    session.ship_package(spark)
    found = session.stored(minhash.near_duplicates(docs), "near")
    gone = found.filter("NOT kept").select("doc_id").distinct()
    several = (found.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select("doc_id"))
    mark = free_name(docs.columns, "_gone")
    marks = gone.select("doc_id", F.lit(True).alias(mark)).union(several.select("doc_id", F.lit(False)))
    marked = attach(docs, session.stored(marks, "marks"), ["doc_id"])
    once = marked.filter(f"{mark} IS NULL").select(*_as_they_were(docs))
    row = F.struct(*_as_they_were(docs))
    # As JSON any row can be compared, one with maps too.
    repeated = (marked.filter(f"NOT {mark}").groupBy("doc_id").agg(F.min_by(row, F.to_json(row)).alias("r"))
                .select("r.*"))
    return once.union(repeated)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of a benchmark item occurs."""
    session.ship_package(spark)
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced and ``n_chars`` brought up to date."""
    session.ship_package(spark)
    before = free_name(docs.columns, "_before")
    cleaned = secrets.redact(docs.withColumn(before, F.col("text")))
    length = F.when(F.col("text").eqNullSafe(F.col(before)), F.col("n_chars")).otherwise(
        F.length("text").cast("long"))
    return cleaned.withColumn("n_chars", length).select(*_as_they_were(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences. Workers that served the other
    stages too have less memory to spare for words already encoded."""
    session.ship_package(spark)
    return packing.pack_documents(docs, cache_entries=200_000)


STAGES = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# Languages are learned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = session.stored(stage(spark, docs, sf_dir), name)
    return docs
