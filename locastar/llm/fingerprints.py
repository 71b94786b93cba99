"""Document fingerprints by a homomorphic multiset hash (operator 3), DataFrame functions only.

A paragraph is a line. Each paragraph is hashed to a wide vector; a
document's fingerprint is the sum of its paragraphs' vectors modulo powers of
two. So the order of paragraphs does not matter, and a paragraph is put in or
taken out by adding or subtracting its vector. The vector has two parts:

* eight lanes modulo 2**32, the halves of four 64-bit hashes of the whole
  paragraph: equal sums mean equal multisets of paragraphs;
* 63 lanes modulo 2**21 (the last third 2**20), three to a 64-bit word: each counts, over the
  paragraph's runs of up to four words, one bit of the run's hash. Centred,
  they are random signs summed over runs, whose inner products estimate how
  many runs two documents share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locastar.llm.common import texts_of, written

#: Runs of up to four words that stay inside a line.
RUN = r"[^\s]+(?:[^\S\n]+[^\s]+){0,3}"
SEEDS = range(4)
PLACES = range(21)
#: One bit in each of the three fields of a word.
FIELDS = 1 | 1 << 21 | 1 << 42
FIELD = (1 << 21) - 1
HALF = (1 << 32) - 1
#: What a word of three fields keeps.
LANES = (1 << 62) - 1


def field(up: int, mask: int):
    """x -> the bits of ``mask`` after a shift right by ``up``, as a lambda of one argument."""
    return lambda x: F.shiftrightunsigned(x, up).bitwiseAND(F.lit(mask).cast("long"))


def seeded(seed: int):
    return lambda p: F.xxhash64(F.lit(seed), p)


def total(values: Column, mask: int) -> Column:
    """Sum of an array of longs, kept below 2**63 at each step."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: (a + x).bitwiseAND(F.lit(mask).cast("long")))


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: struct(eq array<long>, runs long, lanes array<long>) of the column ``text``."""
    hashed = df.withColumn("_paragraphs", F.split(F.col(text), "\n", -1)) \
        .withColumn("_runs", F.transform(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0)), lambda r: F.xxhash64(r))) \
        .withColumn("_hashes", F.array(*[F.transform("_paragraphs", seeded(s)) for s in SEEDS]))
    eq = [total(F.transform(F.col("_hashes")[s], field(up, HALF)), HALF) for s in SEEDS for up in (0, 32)]
    # fields count to 2**21: more runs wrap round inside the word, alike for equal texts
    lanes = [total(F.transform("_runs", field(p, FIELDS)), LANES) for p in PLACES]
    return hashed.withColumn(out, F.struct(
        F.array(*eq).alias("eq"), F.size("_runs").cast("long").alias("runs"), F.array(*lanes).alias("lanes"))) \
        .drop("_paragraphs", "_runs", "_hashes")


def plus(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of a multiset after another's paragraphs are put in (or, with -1, taken out)."""
    part = lambda name, mask: F.zip_with(a[name], b[name], lambda x, y: (x + y * F.lit(sign)).bitwiseAND(F.lit(mask).cast("long")))
    return F.struct(part("eq", HALF).alias("eq"), (a["runs"] + b["runs"] * F.lit(sign)).alias("runs"),
                    part("lanes", LANES).alias("lanes"))


def spelled(vector: Column) -> Column:
    """The fingerprint as a string: equal for equal multisets of paragraphs."""
    wide = lambda c, n: F.array_join(F.transform(c, lambda x: F.lpad(F.lower(F.hex(x)), n, "0")), "")
    return F.concat_ws("-", wide(vector["eq"], 8), F.hex(vector["runs"]), wide(vector["lanes"], 16))


def centred(vector: Column) -> Column:
    """63 sums of random signs: twice each lane less the number of runs."""
    fields = F.concat(*[F.transform(vector["lanes"], field(up, FIELD)) for up in (0, 21, 42)])
    return F.transform(fields, lambda c: (c * 2 - vector["runs"]).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """0 to 1 from two vectors alone: 1 for equal ones, else the cosine of the run
    parts, which estimates the shared runs; never below 0 nor, if they differ, at 1."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    x, y = centred(a), centred(b)
    norm = F.sqrt(dot(x, x)) * F.sqrt(dot(y, y))
    cosine = F.when(norm > 0, dot(x, y) / norm).otherwise(0.0)
    return F.when((a["eq"] == b["eq"]) & (a["runs"] == b["runs"]) & (a["lanes"] == b["lanes"]), 1.0) \
        .otherwise(F.least(F.lit(0.999999), F.greatest(F.lit(0.0), cosine)))


def neighbours(ids: DataFrame) -> DataFrame:
    """Adds next_id: the next of the distinct ids in ascending order; the first follows the last.

    Ids are dealt out by range, so no task sorts them all; the blocks' first
    ids, one row per partition, link the blocks.
    """
    ranged = written(ids.repartitionByRange("doc_id").withColumn("block", F.spark_partition_id()), "ids")
    edges = ranged.groupBy("block").agg(F.min("doc_id").alias("low"))
    order = Window.orderBy("block")
    edges = edges.select("block", F.lead("low").over(order).alias("next_low"), F.min("low").over(Window.partitionBy()).alias("lowest"))
    inside = Window.partitionBy("block").orderBy("doc_id")
    return ranged.withColumn("after", F.lead("doc_id").over(inside)).join(edges, "block").select(
        *ids.columns, F.coalesce("after", "next_low", "lowest").alias("next_id"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text and of its edited text (its last quarter replaced by the
    beginning of the next document): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    A null text is empty. Rows without a doc_id have no place in the order and
    are left out. Rows that repeat a doc_id appear each; the next document is
    then that of the next larger id, of several rows the least in
    (length, text). A lone document follows itself. No rows give no rows.
    """
    base = texts_of(docs.where("doc_id is not null")).select(F.col("doc_id").cast("long"), "text") \
        .withColumn("n_chars", F.length("text").cast("long"))
    links = neighbours(base.groupBy("doc_id").agg(F.max("n_chars").alias("n")))
    # how much of each document its predecessor takes: known before any text moves
    wanted = links.select(
        F.col("next_id").alias("doc_id"), F.col("doc_id").alias("for_id"), F.floor(F.col("n") / 4).cast("int").alias("n_head"))
    marked = with_vector(base, "text", "vector")
    heads = marked.join(wanted, "doc_id").select(
        F.col("for_id").alias("doc_id"), "n_chars", F.expr("left(text, n_head)").alias("head"), F.col("vector").alias("next_vector"))
    heads = heads.groupBy("doc_id").agg(F.min(F.struct("n_chars", "head", "next_vector")).alias("next")) \
        .select("doc_id", F.col("next.head").alias("head"), F.col("next.next_vector").alias("next_vector"))
    edited = marked.join(heads, "doc_id").withColumn(
        "edited", F.expr("concat(left(text, cast(n_chars - n_chars div 4 as int)), left(head, cast(n_chars div 4 as int)))")) \
        .select("doc_id", "n_chars", "edited", "vector", "next_vector")
    both = with_vector(edited, "edited", "edited_vector")
    a, e, n = F.col("vector"), F.col("edited_vector"), F.col("next_vector")
    return both.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), spelled(a).alias("fingerprint"),
                       spelled(e).alias("edited_fingerprint"), likeness(a, e).alias("near_edited"), likeness(a, n).alias("near_next"))
