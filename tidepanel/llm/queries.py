"""Every operator applied to its whole table with production parameters, with SQL where SQL
can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import oracles
from tidepanel.llm.decontamination import contamination
from tidepanel.llm.hard_negatives import hard_negatives
from tidepanel.llm.language_id import identify
from tidepanel.llm.language_model import perplexities
from tidepanel.llm.mixing import mix
from tidepanel.llm.near_duplicates import near_duplicates
from tidepanel.llm.periodic_runs import periodic_runs
from tidepanel.llm.preferences import preference_pairs, with_replies_of_others
from tidepanel.llm.quality_rules import quality_rules
from tidepanel.llm.secrets import BASE, find_secrets
from tidepanel.llm.substring_dedup import without_repeats
from tidepanel.llm.token_counts import token_counts
from tidepanel.llm.toxicity import toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = dict(oracles.SQL)
TOKENIZER = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", F.array_join("failed", ",").alias("failed"), "kept")


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@query
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["number"] < len(BASE))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


@query
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumns({"items": F.array_join("items", ","), "similarity": F.round("similarity", 6)})


@query
def op10_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference_pairs(*with_replies_of_others(table(spark, sf_dir, "conversations")))
    spans = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return pairs.withColumns({"chosen_mask": spans("chosen_mask"), "rejected_mask": spans("rejected_mask")})


SQL["op10_preference_pairs"] = """
WITH last AS (
  SELECT conv_id, max(turn) AS turn FROM conversations
           WHERE role = 'assistant' AND conv_id IS NOT NULL GROUP BY 1),
reply AS (SELECT l.conv_id, l.turn, max(c.text) AS text FROM last l
  JOIN conversations c ON c.conv_id = l.conv_id AND c.turn = l.turn AND c.role = 'assistant' GROUP BY 1, 2),
next AS (SELECT conv_id, coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS partner FROM reply),
sides AS (
  SELECT c.conv_id, c.turn, coalesce(c.role, '') AS role, coalesce(c.text, '') AS chosen,
         coalesce(CASE WHEN c.turn = own.turn AND c.role = 'assistant' THEN other.text ELSE c.text END, '') AS rejected
  FROM conversations c JOIN reply own ON own.conv_id = c.conv_id AND c.turn <= own.turn
  JOIN next ON next.conv_id = own.conv_id JOIN reply other ON other.conv_id = next.partner),
marked AS (
  SELECT *, min(CASE WHEN chosen <> rejected THEN turn END) OVER (PARTITION BY conv_id) AS first FROM sides),
drawn AS (
  SELECT *, first IS NULL OR turn < first AS common,
         '<|' || role || '|>' || chr(10) || chosen || '<|end|>' || chr(10) AS c,
         '<|' || role || '|>' || chr(10) || rejected || '<|end|>' || chr(10) AS r FROM marked),
placed AS (
  SELECT *, sum(CASE WHEN common THEN 0 ELSE length(c) END) OVER w AS c_end,
         sum(CASE WHEN common THEN 0 ELSE length(r) END) OVER w AS r_end
  FROM drawn WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
pairs AS (
  SELECT conv_id, (count(*) FILTER (WHERE common))::INTEGER AS n_common,
         coalesce(string_agg(c, '' ORDER BY turn) FILTER (WHERE common), '') AS prompt,
         coalesce(string_agg(c, '' ORDER BY turn) FILTER (WHERE NOT common), '') AS chosen,
         coalesce(string_agg((c_end - length(chosen) - 8)::BIGINT || ':' || c_end::BIGINT, ',' ORDER BY turn)
                  FILTER (WHERE NOT common AND role = 'assistant'), '') AS chosen_mask,
         coalesce(string_agg(r, '' ORDER BY turn) FILTER (WHERE NOT common), '') AS rejected,
         coalesce(string_agg((r_end - length(rejected) - 8)::BIGINT || ':' || r_end::BIGINT, ',' ORDER BY turn)
                  FILTER (WHERE NOT common AND role = 'assistant'), '') AS rejected_mask
  FROM placed GROUP BY conv_id)
SELECT *, chosen_mask <> '' AND rejected_mask <> '' AND chosen <> rejected AS differs FROM pairs
"""


@query
def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumns({c: F.round(c, 6) for c in ("perplexity", "excess", "cutoff")})


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted", "spans")


def with_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): documents whose id's crc32 is a multiple of ten become periodic from a
    word on that the crc32 picks; the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    div = lambda a, b: F.call_function("div", a, b)
    g = div(h, F.lit(10).cast("long"))
    rows = docs.select("doc_id", "text", (h % 10 == 0).alias("chosen"), g.alias("g")).withColumn(
        "words", F.when(F.col("chosen"), F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)"), 1)))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    period = 1 + div(n - F.col("a"), 3 + F.col("g") % 8)
    source = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % period)
    text = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1),
                                    lambda i: F.get("words", source(i).cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), text).otherwise(F.col("text")).alias("text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumns({"n_runs": F.size("runs").cast("long"), "best": best})
    return found.select(
        "doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.call_function("div", 1000 * F.col("best.length"), -F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", moved.alias("label"), "embedding"))


SQL["op13_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
anchors AS (SELECT * FROM rows WHERE vec_id % 100 = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, x.vec_id, a.label = x.label AS same,
         list_dot_product(a.q, x.q)::BIGINT AS score FROM anchors a JOIN rows x ON a.vec_id <> x.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id,
       positive_score, score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT same
  AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""


@query
def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", gone.alias("n_removed"),
                        F.size("removed").cast("long").alias("n_spans"), "kept_sha256")
