"""From raw documents to a mixed training corpus: the stages, each written and read again.

Verdicts refer to documents by id. A row with a null id cannot be referred to and passes the
filtering stages; rows that share an id share the verdict "rejected" of any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm.common import drop_ids, keep_ids
from tidepanel.llm.decontamination import matches
from tidepanel.llm.language_model import perplexities
from tidepanel.llm.mixing import mix
from tidepanel.llm.near_duplicates import near_duplicates
from tidepanel.llm.secrets import find_secrets, redacted
from tidepanel.session import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity trusted text of their language does not exceed."""
    verdicts = perplexities(docs, _table(spark, sf_dir, "labels"))
    return drop_ids(docs, verdicts.where("not kept").select("doc_id"), "doc_id")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and one row of each id."""
    verdicts = near_duplicates(docs)
    kept = drop_ids(docs, verdicts.where("not kept").select("doc_id"), "doc_id")
    again = materialise(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
                        .where("n > 1").select("doc_id"), "repeated")
    return drop_ids(kept, again, "doc_id").unionByName(
        keep_ids(kept, again, "doc_id").dropDuplicates(["doc_id"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = matches(docs, _table(spark, sf_dir, "benchmark"))
    return drop_ids(docs, found.select("doc_id"), "doc_id")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    rest = F.struct(F.lit(0).alias("no_column"), *[c for c in docs.columns if c not in ("doc_id", "text")])
    found = find_secrets(docs.select("doc_id", "text", rest.alias("rest")))
    out = {c: F.col("rest")[c] for c in docs.columns} | {"doc_id": F.col("doc_id"), "text": redacted(F.col("text"), F.col("spans"))}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.size("spans") > 0, F.length(out["text"])).otherwise(out["n_chars"]) \
            .cast(docs.schema["n_chars"].dataType)
    return found.select(*[out[c].alias(c) for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    return mix(docs)


STAGES = [("quality", quality), ("deduplicate", deduplicate), ("decontaminate", decontaminate),
          ("redact", redact), ("mixture", mixture)]

#: The language model and the near-duplicate sketches are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
