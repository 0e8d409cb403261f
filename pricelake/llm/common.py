"""Helpers shared by the corpus operators: stored intermediates, row keys, Arrow batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import ensure_checkpoint_dir

#: Spark's own setting that removes a query's shuffle files when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Column names the operators add to a row while they work on it.
KEY_ID, KEY_HASH = "__llm_id", "__llm_hash"

#: A numpy step works on about so many bytes of text at once, whatever the batch size.
STEP_BYTES = 1 << 20

#: Rows of one Arrow batch; long texts make larger batches costly.
BATCH_ROWS = 1000


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read again.

    It cuts the lineage: a lost executor costs no earlier stage, and every
    later reader sees the same rows. The shuffle files of the write are of no
    further use and go with its end, so that steps don't add up on disk. ``codec`` is the session's unless given.
    """
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), f"llm-{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's rows per Arrow batch to ``rows`` if it allows more."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, str(rows))


def pieces(batches: Iterator[pa.RecordBatch], text: str, step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows with about ``step`` bytes of text (one row at least)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if batch.num_rows <= 1 or column.nbytes <= step:
            if batch.num_rows:
                yield batch
            continue
        begin, size = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
            if size and size + n > step:
                yield batch.slice(begin, i - begin)
                begin, size = i, 0
            size += n
        yield batch.slice(begin)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with the row key: the id and a hash of the text.

    Repeated rows have one key and equal results; a null text has the key of the empty text.
    """
    return docs.select(
        F.col(id_col).alias(KEY_ID), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        text_hash(F.col(text_col)).alias(KEY_HASH))


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and the row key."""
    return docs.withColumns({KEY_ID: F.col(id_col), KEY_HASH: text_hash(F.col(text_col))})


def attach(docs: DataFrame, side: DataFrame, how: str = "left") -> DataFrame:
    """Join per-document facts to keyed documents; null ids match null ids. ``side`` has one row per key."""
    right = side.withColumnsRenamed({KEY_ID: "__side_id", KEY_HASH: "__side_hash"})
    joined = docs.join(right, docs[KEY_ID].eqNullSafe(right["__side_id"]) & (docs[KEY_HASH] == right["__side_hash"]), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("__side_id", "__side_hash")
