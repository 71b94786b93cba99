"""What the operators of this subpackage share: reading, scratch tables, batches.

Every operator takes a DataFrame with at least ``doc_id`` and ``text`` (or the
columns that it names) and ignores any other column, whatever its name.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.session import ensure_checkpoint_dir

#: Rows in one Arrow batch; long documents make batches of a few ten MB at most.
BATCH_ROWS = 1000
#: Text handled at once inside a task, in characters: a worker's arrays are some
#: fifty times as large.
CHUNK_CHARS = 512 << 10


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids and whole texts of ``documents``; Arrow batches are kept small."""
    small_batches(spark)
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def texts_of(docs: DataFrame, *more: str) -> DataFrame:
    """(doc_id, text, *more) with a null text as the empty text."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder of ``spark.checkpoint.dir`` and read back.

    The written table cuts the lineage: a lost executor costs a re-read, not
    the work before it.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(texts: list, limit: int = CHUNK_CHARS):
    """Slices (start, stop) of ``texts`` of about ``limit`` characters each; one text at least."""
    start, held = 0, 0
    for k, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield start, k
            start, held = k, 0
        held += len(t)
    if start < len(texts):
        yield start, len(texts)
