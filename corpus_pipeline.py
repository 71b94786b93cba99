"""A corpus from raw documents: quality, exact and near copies, personal data, packing.

Each stage calls one operator of ``locastar.llm``, gets all rows that the
stage before it kept, and returns the columns of ``documents`` (the last one
returns packed pieces). A row is known by its doc_id and its text: rows that
share an id, or have none, are decided on each. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.llm import exact_dedup, near_dup, packing, pii, quality
from locastar.llm.common import fresh, small_batches, table, written
from locastar.llm.registry import PII_KEY, tokenizer_path
from locastar.operators.numbering import row_numbers
from locastar.session import ensure_checkpoint_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 5 scores at 0.3 or more.

    A null text is scored as an empty one, repeated rows and rows without
    doc_id each; columns stay as they are.
    """
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def with_hash(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the hash of each text (null: empty), and its column's name."""
    sha = fresh(docs, "sha")
    return docs.withColumn(sha, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))), sha


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null: empty) the row with the largest doc_id; of rows that repeat it, one.

    A row without doc_id stays if no row with one has its text, one of each text.
    """
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    decided = written(exact_dedup.exact_dedup(docs, keep="max").where("kept")
                      .select(F.col("doc_id").alias("k_id"), F.unhex("text_sha256").alias("k_sha")), "exact")
    marked, sha = with_hash(docs)
    named = marked.join(decided, (F.col("doc_id") == F.col("k_id")) & (F.col(sha) == F.col("k_sha")), "left_semi") \
        .dropDuplicates(["doc_id", sha])
    unnamed = marked.where("doc_id is null").dropDuplicates([sha]).join(decided, F.col(sha) == F.col("k_sha"), "left_anti")
    return named.unionByName(unnamed).select(*docs.columns)


def with_own_ids(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with an id for each (doc_id, text), and its column's name: the
    doc_id where it stands for one text, else a number above all of them."""
    marked, sha = with_hash(docs)
    shared = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").select(F.col("doc_id").alias("s_id"))
    odd = marked.select("doc_id", sha).join(shared, F.col("doc_id").eqNullSafe(F.col("s_id")), "left_semi").distinct()
    largest = docs.agg(F.max("doc_id")).first()[0]
    own = fresh(marked, "own")
    numbered = row_numbers(odd, [F.asc_nulls_last("doc_id"), F.asc(sha)], own, largest or 0)
    given = written(numbered.select(F.col("doc_id").alias("o_id"), F.col(sha).alias("o_sha"), own), "own")
    keyed = marked.join(given, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col(sha) == F.col("o_sha")), "left") \
        .withColumn(own, F.coalesce(own, "doc_id"))
    return keyed.select(*docs.columns, own), own


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id in each group linked by 80 % of five-word shingles.

    Null and empty texts are linked with nothing and stay. Rows that share an
    id with another text, or have none, are documents of their own that come
    after the others; of rows that repeat id and text all stay.
    """
    ensure_checkpoint_dir(spark)
    keyed, own = with_own_ids(docs)
    kept = near_dup.near_duplicates(keyed.select(F.col(own).alias("doc_id"), "text"), words=5, percent=80) \
        .where("kept").select(F.col("doc_id").alias("k_id"))
    return keyed.join(kept, F.col(own) == F.col("k_id"), "left_semi").select(*docs.columns)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; ``n_chars`` follows the text. Every row stays, null and empty texts as they are."""
    ensure_checkpoint_dir(spark)
    done = pii.pseudonymise(docs, PII_KEY, out=fresh(docs, "pii"))
    if "n_chars" in docs.columns:
        changed = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
        done = done.withColumn("n_chars", changed)
    return done.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their places in sequences.

    A null or empty text is the end id alone; repeated rows and rows without doc_id are packed each.
    """
    ensure_checkpoint_dir(spark)
    small_batches(spark)
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), 2048, 1)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", without_copies),
    ("minhash near-dedup", without_near_copies),
    ("pii", pseudonyms),
    ("packing", packed),
]

#: A trained classifier and a tokenizer are beyond SQL; tests/llm checks run() by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    *first, (_, last) = STAGES
    for k, (_, stage) in enumerate(first):
        docs = written(stage(spark, docs, sf_dir), f"stage{k}")
    return last(spark, docs, sf_dir)
