"""Publishing table content safely.

Spark cannot overwrite a Parquet path it is reading from, and plain Parquet
has no MERGE. Two publishing modes cover the merge family:

* ``VersionedTable`` — each write goes to a new ``v=<n>`` folder; readers take
  the newest folder whose write committed (has ``_SUCCESS``). A failed write
  leaves the previous version current. Used for whole-table replace and for
  small tables (catalog, marts).
* ``merge_partitions`` — for big date-partitioned tables: only the partitions
  the new rows touch are read (static partition filter), merged, written once to
  a hidden folder of the table and moved in. Untouched days are never read or rewritten.

Several partitions can't be moved in one step. ``swap_in`` therefore notes
its intent in the table first: the next writer, or a reader that finds the note
long after (``GRACE_SECONDS``), finishes a swap that was cut short (``recover``), so a
table shows all days of a write or none. One writer a table at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import scratch_dir

_PREFIX = "v="
#: Hidden names in a table's folder: rows of a write not moved in yet, and the note that says they are complete.
_STAGING, _INTENT = "_staging-", "_swap-"
#: Readers leave a swap to its writer for so long; moving a write's partitions in takes seconds.
GRACE_SECONDS = 600
#: Committed versions that a ``VersionedTable`` keeps, unless told otherwise: readers of the last few stay valid.
KEEP_VERSIONS = 8


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def partition_folder(column: str, value) -> str:
    """The folder name that Spark gives a partition value."""
    if value is None or value == "":
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    from pyspark.sql import SparkSession as _Session

    escape = _Session.active()._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{escape(column)}={escape(str(value))}"


def drop_other_partitions(spark: SparkSession, root: str, depth: int, leaf: str, kept: set[tuple[str, ...]]) -> None:
    """Delete the folders ``leaf`` at ``depth`` below ``root`` whose parents are not among ``kept``."""
    fs, p = _fs(spark, root)
    for st in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "/".join(["*=*"] * depth + [leaf]))) or []:
        at, parents = st.getPath(), []
        for _ in range(depth):
            at = at.getParent()
            parents.append(at.getName())
        if tuple(reversed(parents)) not in kept:
            fs.delete(st.getPath(), True)


def drop_partition(spark: SparkSession, root: str, **values) -> None:
    """Delete one partition, named by its columns in order, if it is there."""
    fs, _ = _fs(spark, root)
    fs.delete(_child(spark, root, "/".join(partition_folder(c, v) for c, v in values.items())), True)


def partition_days(spark: SparkSession, root: str, column: str) -> set:
    """The days of a table partitioned by a date column, from its folders alone."""
    import datetime as _dt

    fs, p = _fs(spark, root)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"{column}=*")) or []
    names = [st.getPath().getName()[len(column) + 1:] for st in found]
    return {None if n == "__HIVE_DEFAULT_PARTITION__" else _dt.date.fromisoformat(n) for n in names}


class VersionedTable:
    """A table stored as ``root/v=<n>/``; the newest committed version is current.

    After each write only the newest ``keep`` committed versions stay (None: all).
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", keep: int | None = KEEP_VERSIONS):
        self.spark, self.root, self.fmt, self.keep = spark, root.rstrip("/"), fmt, keep

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.root)
        if not fs.exists(p):
            return []
        out = []
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith(_PREFIX) and name[len(_PREFIX):].isdigit():
                if fs.exists(st.getPath().suffix("/_SUCCESS")):
                    out.append(int(name[len(_PREFIX):]))
        return sorted(out)

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path_of(self, version: int) -> str:
        return f"{self.root}/{_PREFIX}{version:06d}"

    def read(self, version: int | None = None) -> DataFrame | None:
        """The current content, or a given committed ``version`` (kept until pruned)."""
        v = self.current() if version is None else version
        if v is None:
            return None
        if version is not None and version not in self.versions():
            raise ValueError(f"no committed version {version} under {self.root}")
        return self.spark.read.format(self.fmt).load(self.path_of(v))

    def write(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Write ``df`` as the next version and return its number."""
        fs, p = _fs(self.spark, self.root)
        taken = []
        if fs.exists(p):
            taken = [int(st.getPath().getName()[len(_PREFIX):]) for st in fs.listStatus(p)
                     if st.getPath().getName().startswith(_PREFIX)
                     and st.getPath().getName()[len(_PREFIX):].isdigit()]
        nxt = max(taken, default=0) + 1
        w = df.write.mode("errorifexists").format(self.fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(self.path_of(nxt))
        if self.keep is not None:
            self.prune(self.keep)
        return nxt

    def apply(self, op: Callable[[DataFrame | None], DataFrame], partition_by: Sequence[str] = ()) -> int:
        """New version = ``op(current content or None)`` — the merge family's entry point."""
        return self.write(op(self.read()), partition_by)

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> int:
        """Truncate-and-insert, atomically for readers."""
        return self.write(df, partition_by)

    def prune(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed versions (returned), and failed writes older than those kept."""
        vs = self.versions()
        gone = vs[:-keep] if keep > 0 else vs
        fs, p = _fs(self.spark, self.root)
        for st in fs.listStatus(p) if gone else []:
            number = st.getPath().getName()[len(_PREFIX):]
            if st.getPath().getName().startswith(_PREFIX) and number.isdigit() and int(number) <= gone[-1]:
                fs.delete(st.getPath(), True)
        return gone


class TableSet:
    """Several tables that become current together.

    A publication ``n`` writes each table to ``root/<table>/v=<n>`` and then
    creates the marker ``root/_sets/<n>``. Readers take the tables of the newest marker, so
    a failure between two tables leaves the publication before it current, whole.
    A table that a publication does not bring stays at the version it had: the marker lists all of them.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int | None = KEEP_VERSIONS):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def _sets(self) -> list[int]:
        fs, p = _fs(self.spark, f"{self.root}/_sets")
        if not fs.exists(p):
            return []
        names = [st.getPath().getName() for st in fs.listStatus(p)]
        return sorted(int(n) for n in names if n.isdigit())

    def versions(self) -> dict[str, int]:
        """The current version of each table."""
        sets = self._sets()
        return self._read_marker(sets[-1]) if sets else {}

    def _read_marker(self, number: int) -> dict[str, int]:
        fs, p = _fs(self.spark, f"{self.root}/_sets/{number}")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {k: int(v) for k, v in json.loads(text).items()}

    def read(self, name: str) -> DataFrame | None:
        """The current content of a table, or None."""
        version = self.versions().get(name)
        return None if version is None else self.spark.read.parquet(f"{self.root}/{name}/{_PREFIX}{version:06d}")

    def publish(self, tables_: Mapping[str, DataFrame]) -> int:
        """Write all of ``tables_`` and make them current at once; returns the publication's number."""
        current, number = self.versions(), 1 + max([0, *self._sets(), *self._tried()])
        for name, df in tables_.items():
            df.write.mode("errorifexists").parquet(f"{self.root}/{name}/{_PREFIX}{number:06d}")
        self._write_marker(number, {**current, **{name: number for name in tables_}})
        self._prune()
        return number

    def _tried(self) -> list[int]:
        """Numbers that a table folder has, with a marker or without (a publication that failed)."""
        fs, p = _fs(self.spark, self.root)
        found = fs.globStatus(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, f"*/{_PREFIX}*")) if fs.exists(p) else []
        return [int(st.getPath().getName()[len(_PREFIX):]) for st in found or []]

    def _write_marker(self, number: int, versions: dict[str, int]) -> None:
        """The marker appears whole: it is written under another name and renamed."""
        fs, hidden = _fs(self.spark, f"{self.root}/_sets/_{number}-{uuid.uuid4().hex}")
        out = fs.create(hidden)
        try:
            out.write(bytearray(json.dumps(versions, sort_keys=True).encode()))
        finally:
            out.close()
        if not fs.rename(hidden, _fs(self.spark, f"{self.root}/_sets/{number}")[1]):
            raise OSError(f"could not publish set {number} under {self.root}")

    def _prune(self) -> None:
        sets = self._sets()
        if self.keep is None or len(sets) <= self.keep:
            return
        fs, _ = _fs(self.spark, self.root)
        kept = [self._read_marker(n) for n in sets[-self.keep:]]
        for n in sets[:-self.keep]:
            for name, version in self._read_marker(n).items():
                if all(k.get(name) != version for k in kept):
                    fs.delete(_fs(self.spark, f"{self.root}/{name}/{_PREFIX}{version:06d}")[1], True)
            fs.delete(_fs(self.spark, f"{self.root}/_sets/{n}")[1], False)


def _child(spark: SparkSession, path: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name)


def recover(spark: SparkSession, path: str, reader: bool = False) -> int:
    """Finish the swaps that were noted but cut short; returns how many.

    A writer also drops staged rows that were never noted. A ``reader`` may run beside a writer: it
    touches nothing but swaps noted more than ``GRACE_SECONDS`` ago.
    """
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return 0
    found = {st.getPath().getName(): st.getModificationTime() / 1000 for st in fs.listStatus(root)}
    noted = [n[len(_INTENT):] for n in found if n.startswith(_INTENT)]
    due = [k for k in noted if not reader or time.time() - found[_INTENT + k] > GRACE_SECONDS]
    for key in due:
        _move_in(spark, path, key)
    for n in found if not reader else ():
        if n.startswith(_STAGING) and n[len(_STAGING):] not in noted:
            fs.delete(_child(spark, path, n), True)
    return len(due)


def _move_in(spark: SparkSession, path: str, key: str) -> None:
    """Put the staged partitions in the place of the table's; may be run again at any point."""
    fs, root = _fs(spark, path)
    staging = _child(spark, path, _STAGING + key)
    for st in fs.listStatus(staging) if fs.exists(staging) else []:
        name = st.getPath().getName()
        if st.isDirectory() and not name.startswith(("_", ".")):
            _replace_partition(fs, st.getPath(), _child(spark, path, name))
    fs.delete(staging, True)
    fs.delete(_child(spark, path, _INTENT + key), False)


def _replace_partition(fs, staged, target) -> None:
    if not fs.exists(staged):
        return
    fs.delete(target, True)
    if not fs.rename(staged, target):
        raise OSError(f"could not move {staged} to {target}")


def swap_in(
    spark: SparkSession, path: str, rows: DataFrame, part_col: str, fmt: str = "parquet", sort_within: Sequence[str] = ()
) -> None:
    """Replace the partitions of the table at ``path`` that ``rows`` have, all or none.

    The rows are written once, to a hidden folder of the table that is laid out like
    the table; when they are complete, a note is written and the partitions are moved in (renames, one a
    partition). A job that dies before the note leaves the table as it was; after it, the next ``recover`` goes on.
    """
    recover(spark, path)
    key = uuid.uuid4().hex
    if sort_within:
        rows = rows.sortWithinPartitions(part_col, *sort_within)
    (rows.write.mode("errorifexists").partitionBy(part_col).format(fmt).save(f"{path.rstrip('/')}/{_STAGING}{key}"))
    fs, _ = _fs(spark, path)
    fs.create(_child(spark, path, _INTENT + key)).close()
    _move_in(spark, path, key)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    part_col: str,
    op: Callable[[DataFrame, DataFrame], DataFrame],
    fmt: str = "parquet",
    sort_within: Sequence[str] = (),
) -> None:
    """Merge ``source`` into the partitioned table at ``path`` with ``op(target, source)``,
    rewriting only the partitions ``source`` touches.

    ``sort_within`` orders each partition's files by those columns, so
    Parquet's per-row-group min/max lets readers that filter on them skip
    most of a day (the order also satisfies the partitioned writer's own sort).

    The touched partition values (days: their number is bounded by the calendar)
    are listed with one small distinct job and become a static partition
    filter, so the scan of the target opens only those partitions. The target
    is read with the source's schema, so a table without a data file yet is
    an empty table. The
    source is persisted for the duration, so it is computed once. The merged
    rows are written once, beside the files they are computed from, and
    moved in when complete (``swap_in``).
    """
    from pyspark import StorageLevel

    src = source.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        recover(spark, path)
        if path_exists(spark, path):
            target = spark.read.schema(src.schema).format(fmt).load(path)
            listed = [r[0] for r in src.select(part_col).distinct().collect()]
            values = [v for v in listed if v is not None]
            cond = F.col(part_col).isin(values) if values else F.lit(False)
            if len(values) < len(listed):
                cond = cond | F.col(part_col).isNull()
            merged = op(target.filter(cond), src.select(*target.columns))
        else:
            merged = src
        swap_in(spark, path, merged, part_col, fmt, sort_within)
    finally:
        src.unpersist()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that writes a DataFrame to the shared checkpoint folder and reads it back, for as long as the block lasts.

    The written table cuts the lineage: a lost executor costs its tasks, not
    the steps before.
    """
    made: list[str] = []

    def store(df: DataFrame) -> DataFrame:
        made.append(scratch_dir(spark, f"scratch-{uuid.uuid4().hex}"))
        df.write.parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    try:
        yield store
    finally:
        for path in made:
            fs, p = _fs(spark, path)
            fs.delete(p, True)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Plain append (no key check)."""
    w = df.write.mode("append").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def with_day(df: DataFrame, ts_col: str = "date_extracted", day_col: str = "day") -> DataFrame:
    """Add the UTC day of ``ts_col`` as the partition column."""
    return df.withColumn(day_col, F.to_date(F.col(ts_col)))
