"""Incremental ingestion: new raw files -> ODS tables, once per file.

A file-source stream over a landing folder, run with
``trigger(availableNow=True)`` (process what is there, then stop — the hourly
poll of the original workflow), hands each micro-batch to ``foreachBatch``.
The checkpoint remembers which files were taken, so each file is processed
once; batch handlers merge by key, or append under the batch's name, so a
retried batch changes nothing.

Documents and lines that are no JSON object or array go to a quarantine
folder with their file and time; payloads and quarantine together account for every line.

Late data: a batch may carry rows of past days; only the days present in
the batch are re-merged (see ``tables.merge_partitions``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import merge, staging
from pricelake.plans.ods import ODS_KEYS, add_to_catalog
from pricelake.sources import tables
from pricelake.sources.raw import (
    BATCH,
    append_batch,
    documents_to_payloads,
    file_name,
    held,
    line_row,
    not_blank,
    position,
    rejected_documents,
    with_body,
)

BatchFn = Callable[[DataFrame, int], None]


def text_stream(spark: SparkSession, in_path: str, json_lines: bool = True, max_files: int | None = None) -> DataFrame:
    """Streaming documents as they landed (value, file, landed_at, split): a line each, or a whole file each.

    ``landed_at`` is the file's modification time, ``split`` where the read split starts in the file.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.option("wholetext", "false" if json_lines else "true").load(in_path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_block_start").alias("split"))


def _documents(landed: DataFrame, json_lines: bool) -> DataFrame:
    return landed.filter(not_blank()) if json_lines else landed


def to_raw(landed: DataFrame, json_lines: bool = True) -> DataFrame:
    """Raw rows of ``text_stream`` rows; see ``rejected`` for what is left out.

    Positions are as in ``sources.raw.load_raw``. Rows are numbered in a batch only: lines of a stream
    itself have no row in theirs.
    """
    row = None
    if json_lines and not landed.isStreaming:
        landed, row = landed.withColumn("__row", line_row()), F.col("__row")
    docs = documents_to_payloads(_documents(landed, json_lines), lenient=True,
                                 keep=("landed_at", "file", "split", *(["__row"] if row is not None else [])))
    ts = F.col("landed_at")
    at = position(file_name("file"), F.col("split"), row, F.col("load_pos"))
    return with_body(docs.select("payload", ts.alias("created_at"), F.to_date(ts).alias("ingest_date"), at.alias("load_pos")))


def rejected(landed: DataFrame, json_lines: bool = True) -> DataFrame:
    """(value, file, landed_at, ingest_date) of the ``text_stream`` rows that ``to_raw`` leaves out."""
    return rejected_documents(_documents(landed, json_lines), keep=("file", "landed_at")).withColumn("ingest_date", F.to_date("landed_at"))


def raw_stream(spark: SparkSession, in_path: str, json_lines: bool = True, max_files: int | None = None) -> DataFrame:
    """Streaming raw rows (payload, created_at, ingest_date, load_pos) from text files.

    The load time is the landed file's modification time: a batch that is
    run again after a failure stamps its rows exactly as the first time, so
    the keyed merges downstream absorb the repeat. A line that holds an array
    gives a row per element. A malformed document or line gives none: failing the batch would
    stall the stream on that file for good (the batch loader
    ``sources.raw.load_raw`` fails instead); ``ingest_stream`` writes it to its quarantine.
    """
    return to_raw(text_stream(spark, in_path, json_lines, max_files), json_lines)


def ingest_stream(
    spark: SparkSession,
    in_path: str,
    checkpoint: str | None,
    on_batch: BatchFn,
    json_lines: bool = True,
    wait: bool = True,
    quarantine: str | None = None,
):
    """Run ``on_batch`` over every file not yet seen under ``in_path``, then stop.

    ``checkpoint=None`` keeps the stream's progress under the shared
    ``spark.checkpoint.dir``, in a folder named after ``in_path`` (so the next
    run of the same feed resumes where this one stopped).

    Malformed documents and lines go to ``quarantine`` (value, file, landed_at; Parquet by ``ingest_date``),
    by default a folder of the feed under ``spark.checkpoint.dir`` (``quarantine_dir``). Each batch
    has a folder ``batch=N`` of its own, which a retry replaces. Rows reach ``on_batch`` with a column
    ``batch``, named after the stream's progress and the batch: handlers that append let it
    own what they write, so a retry replaces that instead of adding to it.
    """
    if checkpoint is None:
        from pricelake.session import scratch_dir

        checkpoint = scratch_dir(spark, "streams/" + _feed(in_path))
    aside = (quarantine or quarantine_dir(spark, in_path)).rstrip("/")

    def fn(landed: DataFrame, epoch_id: int) -> None:
        # The query's own id lives in its checkpoint: a new checkpoint never takes an old one's batches for its own.
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or _feed(checkpoint)
        broken = rejected(landed, json_lines)
        if not broken.isEmpty():
            broken.write.mode("overwrite").partitionBy("ingest_date").parquet(f"{aside}/run={run}/batch={epoch_id}")
        on_batch(to_raw(landed, json_lines).withColumn(BATCH, F.lit(f"{run}-{epoch_id}")), epoch_id)

    q = (text_stream(spark, in_path, json_lines).writeStream
         .foreachBatch(fn)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    if wait:
        q.awaitTermination()
    return q


def _feed(path: str) -> str:
    """A folder name for a path."""
    return hashlib.sha1(path.encode()).hexdigest()[:16]


def quarantine_dir(spark: SparkSession, in_path: str) -> str:
    """Where ``ingest_stream`` puts a feed's malformed documents unless told otherwise."""
    from pricelake.session import scratch_dir

    return scratch_dir(spark, "quarantine/" + _feed(in_path))


def land_batch(raw_root: str) -> BatchFn:
    """Batch handler: append the batch to the raw zone (partitioned by day, then batch), once however often it is retried."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        with held(batch) as rows:
            append_batch(rows, raw_root)
    return fn


def fan_out_batch(sinks) -> BatchFn:
    """Batch handler: write each batch to several sinks, computing it once
    (``sources.raw.fan_out``). A retried batch replaces what it wrote to
    appending file sinks before, so each sink holds it once."""
    from pricelake.sources.raw import fan_out

    def fn(batch: DataFrame, epoch_id: int) -> None:
        fan_out(batch, sinks)
    return fn


_STAGERS = {"items": staging.stage_book_a, "history": staging.stage_history, "listings": staging.stage_book_b}


def _merge_staged(spark: SparkSession, batch: DataFrame, kind: str, ods_path: str,
                  product_path: str | None) -> list:
    """Stage a batch once (kept while it is read twice), insert its new names
    into the catalog, upsert its rows into the day-partitioned table; returns
    the touched days."""
    from pyspark import StorageLevel

    from pricelake.operators.catalog import catalog_candidates

    staged = _STAGERS[kind](batch, keep_catalog=True).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if product_path is not None:
            fresh = catalog_candidates(staging.catalog_part(staged))
            add_to_catalog(spark, product_path, fresh)
        rows = tables.with_day(staging.dedup_staged(staged).filter(F.col("date_extracted").isNotNull()))
        days = [r[0] for r in rows.select("day").distinct().collect()]
        tables.merge_partitions(spark, ods_path, rows, "day", lambda t, s: merge.upsert(t, s, ODS_KEYS),
                                sort_within=ODS_KEYS)
    finally:
        staged.unpersist()
    return days


def merge_batch(spark: SparkSession, ods_path: str, kind: str = "items", product_path: str | None = None) -> BatchFn:
    """Batch handler: stage the batch's payloads of one source kind, keep the
    latest per (key, time) and upsert into the day-partitioned ODS table;
    with ``product_path``, new names also go into the catalog (insert-ignore)."""
    def fn(batch: DataFrame, epoch_id: int) -> None:
        _merge_staged(spark, batch, kind, ods_path, product_path)
    return fn


def merge_and_refresh_batch(spark: SparkSession, ods_root: str, marts_root: str, kind: str = "items",
                            **mart_args) -> BatchFn:
    """Batch handler: merge the batch into its ODS table (and its new names
    into the catalog), then recompute the marts for exactly the days the
    batch touched and merge them in.

    Late data is handled by this rule: a snapshot arriving days later lands in
    its own day and that day's mart rows are recomputed and replaced.
    """
    from pricelake.plans.mart_refresh import run_marts

    target = {"items": "book_a", "history": "history", "listings": "book_b"}[kind]
    root = ods_root.rstrip("/")

    def fn(batch: DataFrame, epoch_id: int) -> None:
        days = _merge_staged(spark, batch, kind, f"{root}/{target}", f"{root}/product")
        if days:
            run_marts(spark, ods_root, marts_root, days=days, **mart_args)
    return fn
