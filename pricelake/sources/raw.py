"""Raw zone: JSON documents -> payload rows, date-partitioned landing, fan-out.

A raw row is ``payload STRING, created_at TIMESTAMP, ingest_date DATE,
load_pos STRUCT, body VARIANT, unparsed STRING, payload_hash BIGINT``: the
element's JSON text, the load time, its UTC day (the partition column), the
element's position in its load (a later element of the same load wins a tie)
and the parsed payload (``functions.json_fields.variant_columns``), which is
all that staging reads.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.json_fields import variant_columns

#: Where an element stands in its load: compared field by field, so neither the number nor the size of files is bounded.
POSITION = T.StructType([T.StructField("file", T.StringType()), T.StructField("split", T.LongType()),
                         T.StructField("row", T.LongType()), T.StructField("item", T.LongType())])

#: White space of JSON; a text reader's blanks are more than these.
JSON_BLANKS = " \t\n\r"

#: Row numbers within a read partition are the low bits of Spark's own row id.
_ROW_MASK = (1 << 33) - 1


def _ts_lit(ingest_ts: _dt.datetime | str):
    return F.lit(ingest_ts).cast("timestamp") if isinstance(ingest_ts, str) else F.lit(ingest_ts)


def position(file: Column | None = None, split: Column | None = None, row: Column | None = None, item: Column | None = None) -> Column:
    """A ``POSITION``; fields left out are NULL (and sort first)."""
    parts = {"file": file, "split": split, "row": row, "item": item}
    return F.struct(*[(F.lit(None) if c is None else c).alias(n) for n, c in parts.items()]).cast(POSITION)


def with_body(raw: DataFrame) -> DataFrame:
    """Raw rows with the parsed payload beside its text: ``body, unparsed, payload_hash``."""
    return raw.withColumn("body", F.try_parse_json("payload")).withColumns(
        {**variant_columns("payload", "body"), "payload_hash": F.xxhash64("payload")})


def _stamp(df: DataFrame, ingest_ts) -> DataFrame:
    ts = _ts_lit(ingest_ts)
    return with_body(df.select("payload", ts.alias("created_at"), F.to_date(ts).alias("ingest_date"), "load_pos"))


def line_row() -> Column:
    """A number that grows along the lines of one read split."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))


def file_name(path: str = "_metadata.file_path") -> Column:
    """One spelling of a path's root: "file:///a" and "file:/a" are the same file."""
    return F.regexp_replace(F.col(path), r"^([A-Za-z0-9+.-]+):///+", "$1:/")


def _placed(df: DataFrame, lines: bool) -> DataFrame:
    """(value, __file, __split, __row): each text's file and place in it.

    Spark reads big splits first, so its own row order depends on file sizes;
    file path, split start and row do not. Nothing is listed, ranked or joined for it.
    """
    split, row = (F.col("_metadata.file_block_start"), line_row()) if lines else (F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    return df.select("value", file_name().alias("__file"), split.alias("__split"), row.alias("__row"))


def not_blank(text_col: str = "value") -> Column:
    """Text that holds more than JSON white space (blank lines of a lines file are no documents)."""
    return F.btrim(F.col(text_col), F.lit(JSON_BLANKS)) != ""


def _elements(text_col: str, strict: bool) -> Column:
    """The elements of a document's root: those of an array, or the object alone.

    Malformed text gives NULL, or fails the query if ``strict``: no JSON, a
    scalar, or anything but white space before or after the root value. The text is
    parsed once, inside an array that ends with the text's own hash: only
    if the root value ends where the text ends does the hash come out second.
    """
    v = F.btrim(F.col(text_col), F.lit(JSON_BLANKS))
    mark = F.xxhash64(v).cast("string")
    tail = F.concat(F.lit(',["'), mark, F.lit('"]]'))
    wrapped = F.when(v.startswith("["), F.concat(F.lit("["), v, tail)).when(
        v.startswith("{"), F.concat(F.lit("[["), v, F.lit("]"), tail))
    parsed = F.from_json(wrapped, "array<array<string>>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})

    def root(x: Column) -> Column:
        whole = (F.size(x) == 2) & (x[1] == F.array(mark)) & (v.startswith("[") | (F.size(x[0]) == 1))
        bad = F.raise_error(F.concat(F.lit("malformed JSON document: "), F.coalesce(F.left(v, F.lit(200)), F.lit("NULL"))))
        return F.when(whole, x[0]).otherwise(bad.cast("array<string>") if strict else F.lit(None))

    return F.transform(F.array(parsed), root)[0]


def rejected_documents(docs: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """The documents that ``documents_to_payloads(lenient=True)`` leaves out. Write them aside; together
    the two outputs account for every document (an empty array is a document without payloads)."""
    return docs.filter(_elements(text_col, strict=False).isNull()).select(text_col, *keep)


def documents_to_payloads(
    docs: DataFrame, text_col: str = "value", lenient: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per element of a root array, one row for a root object, none
    for an empty array; each payload is the element's JSON text (``null`` for a JSON null).

    A malformed document - NULL, blank, a scalar, broken JSON, or text before or after the
    root value - fails the load (as a JSON reader would), unless ``lenient``, which skips it
    (see ``rejected_documents``). ``keep`` columns of ``docs`` ride along.
    """
    return docs.select(F.posexplode(_elements(text_col, strict=not lenient)).alias("load_pos", "payload"), *keep).select(
        F.coalesce("payload", F.lit("null")).alias("payload"), F.col("load_pos").cast("bigint").alias("load_pos"), *keep)


def _documents(spark: SparkSession, path: str | Sequence[str], json_lines: bool, suffix: str | None) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", f"*{suffix}") if suffix else spark.read
    docs = _placed(reader.text(path, wholetext=not json_lines), json_lines)
    return docs.filter(not_blank()) if json_lines else docs


def load_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    ingest_ts,
    json_lines: bool = False,
    suffix: str | None = None,
    lenient: bool = False,
) -> DataFrame:
    """Load JSON documents as raw payload rows stamped with ``ingest_ts``.

    ``json_lines=False``: each file is one JSON document (root array or
    object), read whole — one task per file, so land big feeds as JSON lines.
    ``json_lines=True``: one JSON document per line (an array line gives a row
    per element; blank lines are none); the reader splits files, so this is the route that scales.
    ``suffix`` (e.g. ``".json"``) takes only files whose name ends with it. A
    malformed document or line fails the load unless ``lenient``;
    ``load_rejected`` then returns what was left out.

    ``load_pos`` orders the rows by file path, place in the file and place in
    a root array, whatever the files' number and sizes.
    """
    docs = documents_to_payloads(_documents(spark, path, json_lines, suffix), lenient=lenient, keep=("__file", "__split", "__row"))
    at = position(F.col("__file"), F.col("__split"), F.col("__row"), F.col("load_pos"))
    return _stamp(docs.select("payload", at.alias("load_pos")), ingest_ts)


def load_rejected(spark: SparkSession, path: str | Sequence[str], json_lines: bool = False, suffix: str | None = None) -> DataFrame:
    """``(file, value)`` of the documents or lines that a lenient ``load_raw`` leaves out."""
    docs = _documents(spark, path, json_lines, suffix).withColumnRenamed("__file", "file")
    return rejected_documents(docs, keep=("file",)).select("file", "value")


def payloads_from_rows(
    df: DataFrame,
    payload_cols: Sequence[str] | None = None,
    ingest_ts=None,
    ts_col: str | None = None,
    pos_col: str | None = None,
) -> DataFrame:
    """Raw rows from an existing DataFrame: ``payload_cols`` (default: all)
    become one JSON object per row (NULL fields omitted, as a source that
    leaves a key out). The load time is a constant ``ingest_ts`` or a column
    ``ts_col``; the position in the load is ``pos_col`` when given. The rows
    carry the parsed payload only ``with_body``.
    """
    cols = list(payload_cols) if payload_cols is not None else list(df.columns)
    ts = F.col(ts_col).cast("timestamp") if ts_col else _ts_lit(ingest_ts)
    pos = F.col(pos_col) if pos_col else F.monotonically_increasing_id()
    return df.select(
        F.to_json(F.struct(*[F.col(c) for c in cols])).alias("payload"),
        ts.alias("created_at"),
        F.to_date(ts).alias("ingest_date"),
        position(row=pos).alias("load_pos"),
    )


def land(raw: DataFrame, path: str, fmt: str = "parquet", stamp=None) -> None:
    """Write raw rows partitioned by ``ingest_date``; re-landing a day replaces
    that day only, other days stay. The rows' days are replaced all or none (``tables.swap_in``).

    ``stamp`` (a date) files the rows under that day instead of their load
    day, e.g. a run's logical date when a past day is loaded late.
    """
    from pricelake.sources import tables

    if stamp is not None:
        day = stamp if isinstance(stamp, _dt.date) else _dt.date.fromisoformat(str(stamp)[:10])
        raw = raw.withColumn("ingest_date", F.lit(day))
    tables.swap_in(raw.sparkSession, path, storable(raw, fmt), "ingest_date", fmt)


def append_raw(raw: DataFrame, path: str, fmt: str = "parquet", batch: str | None = None) -> None:
    """Append raw rows. With ``batch``, a rerun of the same batch replaces what it wrote before;
    without, it duplicates the rows (``land`` does neither: it replaces days)."""
    if batch is None:
        storable(raw, fmt).write.mode("append").partitionBy("ingest_date").format(fmt).save(path)
    else:
        with held(raw.withColumn(BATCH, F.lit(batch))) as rows:
            append_batch(rows, path, fmt, ("ingest_date",))


#: Partition column that names the batch a row came with.
BATCH = "batch"


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` persisted (memory, spilling to disk) for several jobs over it."""
    from pyspark import StorageLevel

    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def append_batch(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ("ingest_date",), **options) -> None:
    """Append rows that carry their batch's name in the column ``batch``, once however often it is tried.

    The folders are the ledger: the batch owns the partitions ``.../batch=<name>``.
    A retry replaces them (dynamic partition overwrite), and drops those that an
    earlier try wrote for days the batch no longer has. A zone is filled either
    by batches or by ``land``: their folders have different depths. Three jobs
    read ``df``: persist it (``held``).
    """
    from pricelake.sources import tables

    spark = df.sparkSession
    names = [r[0] for r in df.select(BATCH).distinct().limit(2).collect()]
    if len(names) > 1:
        raise ValueError(f"one batch at a time, not {names}")
    if not names:
        return
    (storable(df, fmt).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options)
        .partitionBy(*partition_by, BATCH).format(fmt).save(path))
    if partition_by:
        kept = {tuple(tables.partition_folder(c, r[c]) for c in partition_by) for r in df.select(*partition_by).distinct().collect()}
        tables.drop_other_partitions(spark, path, len(partition_by), tables.partition_folder(BATCH, names[0]), kept)


def storable(df: DataFrame, fmt: str) -> DataFrame:
    """``df`` without the VARIANT columns where the format can't hold them (text columns say the same)."""
    if fmt not in ("orc", "csv", "avro"):
        return df
    return df.drop(*[f.name for f in df.schema.fields if isinstance(f.dataType, T.VariantType)])


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The landed raw zone; filter ``ingest_date`` to prune partitions."""
    from pricelake.sources import tables

    tables.recover(spark, path, reader=True)
    return spark.read.format(fmt).load(path)


@dataclass
class Sink:
    path: str
    fmt: str = "parquet"
    mode: str = "append"
    partition_by: Sequence[str] = ("ingest_date",)
    options: dict = field(default_factory=dict)


def fan_out(df: DataFrame, sinks: Iterable[Sink]) -> None:
    """Write the same rows to several sinks, computing them once.

    Rows with a ``batch`` column go to appending sinks once however often the
    batch is retried (``append_batch``). The rows are persisted (memory and disk) for the duration of the writes;
    a lost executor only recomputes its own partitions from the lineage.
    """
    with held(df) as cached:
        for s in sinks:
            if s.mode == "append" and BATCH in cached.columns:
                append_batch(cached, s.path, s.fmt, s.partition_by, **s.options)
                continue
            w = storable(cached, s.fmt).write.mode(s.mode).format(s.fmt).options(**s.options)
            if s.partition_by:
                w = w.partitionBy(*s.partition_by)
            w.save(s.path)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Names list: one per line, white space at both ends dropped, blank lines too -> ``name``."""
    name = F.regexp_replace("value", r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return spark.read.text(path).select(name.alias("name")).filter(F.col("name") != "")


def read_ids(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """Id list file (YAML ``- 123`` items or bare numbers, one per line) -> ``id, ord``.

    ``n`` keeps the first ``n`` ids in file order (a bounded top-n, merged
    from per-partition top-n, not a global sort).
    """
    ids = (
        _placed(spark.read.text(path), lines=True)
        .select(F.regexp_extract("value", r"^\s*(?:-\s*)?(\d+)\s*$", 1).alias("txt"),
                position(F.col("__file"), F.col("__split"), F.col("__row")).alias("ord"))
        .filter(F.col("txt") != "")
        .select(F.col("txt").cast("bigint").alias("id"), "ord")
    )
    return ids.orderBy("ord").limit(n) if n is not None else ids
