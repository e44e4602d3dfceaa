"""Training-corpus pipeline over ``documents``.

Five stages, each written as Parquet and read again as the next one's input:

1. quality rules: failing lines go, documents that the rules reject go;
2. SimHash near-dedup: one row of each group stays, that of the smallest id;
3. benchmark decontamination: contaminated documents go;
4. secret scan: secrets are masked in the text;
5. best-fit packing: the remaining texts become sequences.

The first four return the columns of ``documents`` (``n_chars`` follows the
text); the last returns the packed pieces.

Each stage says what it does with nulls, ties and repeated rows; an empty table
passes all of them as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import fm_decontam, line_rules, packing, secret_forest, simhash_gray
from rentscope.llm.catalog import word_tokenizer
from rentscope.session import scratch_path
from rentscope.sources.tables import table


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with the length brought in line with the text."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their failing lines, where the rules keep them.  A null or
    empty text has fewer than 50 words and goes; repeated rows are judged alike."""
    # the whole row travels as one value, so that no column of it meets a figure's name
    judged = line_rules.apply_rules(docs.select(F.struct("*").alias("row"), "text"))
    # a generator instead of a filter: a filter's condition is pushed below and evaluated a second time
    kept = judged.select(F.inline(F.when(F.col("kept"), F.array(F.struct("row", "clean_text")))))
    return _with_text(kept.select("row.*", "clean_text").withColumn("text", F.col("clean_text")), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near duplicates, whatever the ids are: the
    smallest id's (null ids last), of several rows of that id the one of the
    smallest row hash.  Rows that share an id but not their text are documents of
    their own; identical rows are one.  Null and empty texts are one group."""
    keyed = docs.select(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("key"), F.struct("*").alias("row"))
    slim = keyed.select("key", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    groups = simhash_gray.near_dup_groups(slim, "key", shingle=3, max_bits=3).select("key", "component_id").distinct()
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    stays = slim.select("key", "doc_id").join(groups, "key").groupBy("component_id").agg(F.min_by("key", rank).alias("key")).select("key")
    return keyed.join(stays, "key", "left_semi").groupBy("key").agg(F.min("row").alias("row")).select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that the benchmark contaminates.  A null text has
    no words and stays; the decision belongs to id and text, so repeated rows share it."""
    found = fm_decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    gone = found.where("contaminated").select(F.col("doc_id").alias("gone_id"), "text_hash").distinct()
    return docs.join(gone, docs.doc_id.eqNullSafe(gone.gone_id) & (F.xxhash64(docs.text) == gone.text_hash),
                     "left_anti")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked.  Null and empty texts stay as they are;
    repeated rows are masked alike."""
    return _with_text(secret_forest.redact(docs, secret_forest.usual_model(spark)), docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces.  A null or empty text is its end id; repeated rows are
    packed each; equal lengths are told apart by rank."""
    return packing.pack(docs, word_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# Fingerprint groups and packing are not expressible in SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
