"""Reversible line dedup: sharded cuckoo filters over an exact reference-count table.

A line's key is the line with blanks stripped at both ends and A-Z
lower-cased. The exact table counts, per key digest, the documents that hold
it; inserting documents adds to it and deleting them subtracts, so each change
can be undone. Keys held by at least ``min_docs`` documents are *frequent*
and lose all their lines. Per shard a cuckoo filter holds the frequent keys;
it also takes insertions and deletions as keys cross the threshold. The
filters only spare lines the trip to the exact table: what a filter lets
through is joined with the table, so a false positive changes nothing.

Defined results: a null or empty text is one empty line; the empty key is
never frequent; a repeated row counts as a document of its own; null ids are
kept. Digests are 128-bit MD5 of the key.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, arrow_rows, attach, keyed, stored, with_key

#: Lines are grouped into shards of about so many frequent keys each.
KEYS_PER_SHARD = 200_000
#: Filters larger than this in total are not sent to the tasks; lines then go to the exact table unfiltered.
FILTER_BYTES = 32 << 20
#: Distinct keys a task counts before it hands them on.
FLUSH_KEYS = 200_000

_BLANKS = b" \t\n\v\f\r"
_COUNTS = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType())])


def line_digests(text: bytes) -> list[bytes | None]:
    """The key digest of each line; None for an empty key."""
    keys = (line.strip(_BLANKS).lower() for line in text.split(b"\n"))
    return [hashlib.md5(key).digest() if key else None for key in keys]


class CuckooFilter:
    """Approximate set of 64-bit hashes: four 16-bit fingerprints a bucket, two buckets a key."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / cls.SLOTS / 0.8))))
        return cls(np.zeros((buckets, cls.SLOTS), dtype=np.uint16))

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(fingerprint, first bucket, second bucket) of each hash."""
        mask = np.uint64(len(self.table) - 1)
        mark = (hashes >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = hashes & mask
        return mark, first.astype(np.int64), (first ^ (self.step(mark) & mask)).astype(np.int64)

    @staticmethod
    def step(mark):
        return (np.asarray(mark).astype(np.uint64) * np.uint64(0x5BD1E995)) >> np.uint64(4)

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        mark, first, second = self.places(hashes)
        return (self.table[first] == mark[:, None]).any(1) | (self.table[second] == mark[:, None]).any(1)

    def insert(self, hashes: np.ndarray) -> None:
        """Add keys; the table doubles by a rebuild at the caller when it is full (raises OverflowError)."""
        rng = np.random.default_rng(len(self.table))
        mask = len(self.table) - 1
        for mark, first, second in zip(*(x.tolist() for x in self.places(hashes)), strict=True):
            at = first if 0 in self.table[first] else second
            for _ in range(self.KICKS):
                free = np.flatnonzero(self.table[at] == 0)
                if len(free):
                    self.table[at, free[0]] = mark
                    break
                slot = int(rng.integers(self.SLOTS))
                mark, self.table[at, slot] = int(self.table[at, slot]), mark
                at ^= int(self.step(mark)) & mask
            else:
                raise OverflowError("the cuckoo filter is full")

    def delete(self, hashes: np.ndarray) -> None:
        """Remove one copy of each key; the keys must have been inserted."""
        for mark, first, second in zip(*(x.tolist() for x in self.places(hashes)), strict=True):
            for at in (first, second):
                slot = np.flatnonzero(self.table[at] == mark)
                if len(slot):
                    self.table[at, slot[0]] = 0
                    break

    @classmethod
    def holding(cls, hashes: np.ndarray) -> CuckooFilter:
        size = len(hashes)
        while True:
            made = cls.sized(size)
            try:
                made.insert(hashes)
                return made
            except OverflowError:
                size = 2 * max(size, 4)


def digest_hashes(digests: list[bytes]) -> np.ndarray:
    """The 64-bit hashes that the filters take, from 16-byte digests."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)[:, 0]


def digest_shards(digests: list[bytes], shards: int) -> np.ndarray:
    """The shard of each digest: bytes 9 to 11 as a number, modulo the number of shards."""
    tail = np.frombuffer(b"".join(digests), dtype=np.uint8).reshape(-1, 16)[:, 8:11].astype(np.int64)
    return (tail[:, 0] * 65536 + tail[:, 1] * 256 + tail[:, 2]) % shards


def reference_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(digest, n): documents per non-empty line key. Tasks add up before the shuffle."""
    arrow_rows(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flushed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["digest", "n"])
            seen.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                keys = set(line_digests((text.as_py() or "").encode()))
                keys.discard(None)
                seen.update(keys)
                if len(seen) >= FLUSH_KEYS:
                    yield flushed()
        if seen:
            yield flushed()

    return docs.select(F.col(text_col)).mapInArrow(count, _COUNTS).groupBy("digest").agg(F.sum("n").alias("n"))


def change_counts(counts: DataFrame, inserted: DataFrame | None = None, deleted: DataFrame | None = None) -> DataFrame:
    """The table after documents came (``inserted``) or went (``deleted``); both are ``reference_counts`` tables.

    ``change_counts(change_counts(t, inserted=x), deleted=x)`` equals ``t``.
    """
    parts = [counts.select("digest", "n")]
    if inserted is not None:
        parts.append(inserted.select("digest", "n"))
    if deleted is not None:
        parts.append(deleted.select("digest", (-F.col("n")).alias("n")))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total.groupBy("digest").agg(F.sum("n").alias("n")).filter("n > 0")


_FILTERS = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("shards", T.IntegerType()),
                         T.StructField("filter", T.BinaryType())])


def _shard(shards: int):
    """``digest_shards`` as a column."""
    return (F.conv(F.hex(F.substring("digest", 9, 3)), 16, 10).cast("int") % shards).cast("int")


def build_filters(frequent: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """(shard, shards, filter): one cuckoo filter per shard of the frequent keys."""
    shards = max(1, -(-frequent.count() // keys_per_shard))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        made = CuckooFilter.holding(digest_hashes(table.column("digest").to_pylist()))
        return pa.table([[key[0].as_py()], [shards], [made.table.tobytes()]], schema=pa.schema(
            [("shard", pa.int32()), ("shards", pa.int32()), ("filter", pa.binary())]))

    return frequent.select("digest", _shard(shards).alias("shard")).groupBy("shard").applyInArrow(build, _FILTERS)


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, min_docs: int) -> DataFrame:
    """The filters after the table changed: keys that became frequent go in, others come out.

    A shard that becomes full is rebuilt twice as large. ``filters`` must not be empty.
    """
    shards = filters.first()["shards"]
    was = before.filter(F.col("n") >= min_docs).select("digest", F.lit(True).alias("was"))
    now = after.filter(F.col("n") >= min_docs).select("digest", F.lit(True).alias("now"))
    both = was.join(now, "digest", "full").select(
        "digest", F.coalesce("was", F.lit(False)).alias("was"), F.coalesce("now", F.lit(False)).alias("now"),
        _shard(shards).alias("shard"))

    def change(key: tuple, old: pa.Table, keys: pa.Table) -> pa.Table:
        digests = keys.column("digest").to_pylist()
        was, now = (np.array(keys.column(c).to_pylist(), dtype=bool) for c in ("was", "now"))
        hashes = digest_hashes(digests) if digests else np.zeros(0, np.uint64)
        try:
            if not old.num_rows:
                raise OverflowError
            table = np.frombuffer(old.column("filter")[0].as_py(), dtype=np.uint16).reshape(-1, CuckooFilter.SLOTS)
            made = CuckooFilter(table.copy())
            made.delete(hashes[was & ~now])
            made.insert(hashes[now & ~was])
        except OverflowError:
            made = CuckooFilter.holding(hashes[now])
        return pa.table([[key[0].as_py()], [shards], [made.table.tobytes()]], schema=pa.schema(
            [("shard", pa.int32()), ("shards", pa.int32()), ("filter", pa.binary())]))

    return filters.groupBy("shard").cogroup(both.groupBy("shard")).applyInArrow(change, _FILTERS)


def _filters_within(filters: DataFrame | None, limit: int) -> tuple[int, dict[int, np.ndarray]] | None:
    """(shards, table by shard) when the filters have at most ``limit`` bytes in total, else None."""
    if filters is None:
        return None
    size, shards = filters.agg(F.sum(F.length("filter")), F.max("shards")).first()
    if size is not None and size > limit:
        return None
    return shards or 1, {r["shard"]: np.frombuffer(r["filter"], dtype=np.uint16).reshape(-1, CuckooFilter.SLOTS)
                         for r in filters.collect()}


def drop_frequent_lines(
    docs: DataFrame,
    frequent: DataFrame,
    filters: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    filter_bytes: int = FILTER_BYTES,
) -> DataFrame:
    """``docs`` with every line whose key is in ``frequent`` (digest) dropped.

    All input columns stay, the text replaced; ``n_lines`` (before dropping)
    and ``n_dropped`` are added, or replace columns of those names. A null
    text becomes an empty one.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    sent = spark.sparkContext.broadcast(_filters_within(filters, filter_bytes))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, digest, number = [], [], []
            for i, text in enumerate(batch.column(1)):
                at: dict[bytes, list[int]] = {}
                for j, key in enumerate(line_digests((text.as_py() or "").encode())):
                    if key:
                        at.setdefault(key, []).append(j)
                row.extend([i] * len(at))
                digest.extend(at)
                number.extend(at.values())
            if not digest:
                continue
            if sent.value is not None:
                shards, tables = sent.value
                hashes, shard = digest_hashes(digest), digest_shards(digest, shards)
                may = np.zeros(len(digest), dtype=bool)
                for k, table in tables.items():
                    own = np.flatnonzero(shard == k)
                    may[own] = CuckooFilter(table).contains(hashes[own])
                keep = np.flatnonzero(may).tolist()
                row, digest, number = ([x[k] for k in keep] for x in (row, digest, number))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column(0), take), pc.take(batch.column(2), take), pa.array(digest, pa.binary()),
                 pa.array(number, pa.list_(pa.int32()))], names=[KEY_ID, KEY_HASH, "digest", "lines"])

    slim = keyed(docs, id_col, text_col)
    schema = T.StructType([slim.schema[KEY_ID], T.StructField(KEY_HASH, T.LongType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("lines", T.ArrayType(T.IntegerType()))])
    # A repeated row gives each of its (key, digest) rows again; the line numbers are the same.
    hits = slim.mapInArrow(lines, schema).join(frequent.select("digest"), "digest", "left_semi")
    drops = hits.groupBy(KEY_ID, KEY_HASH).agg(F.flatten(F.collect_set("lines")).alias("__llm_lines"))

    rest = [f for f in docs.schema if f.name not in ("n_lines", "n_dropped")]
    out = T.StructType([T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in rest]
                       + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts, counts, gone = [], [], []
            for text, drop in zip(batch.column(names.index(text_col)), batch.column(names.index("__llm_lines")), strict=True):
                parts = (text.as_py() or "").split("\n")
                drop = set(drop.as_py() or ())
                counts.append(len(parts))
                gone.append(len(drop))
                texts.append("\n".join([p for j, p in enumerate(parts) if j not in drop]) if drop else text.as_py() or "")
            columns = [pa.array(texts, pa.string()) if f.name == text_col else batch.column(names.index(f.name)) for f in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(gone, pa.int64())], names=out.names)

    whole = with_key(docs.select([F.col(f"`{f.name}`") for f in rest]), id_col, text_col)
    return attach(whole, drops).drop(KEY_ID, KEY_HASH).mapInArrow(cut, out)


def dedup_lines(docs: DataFrame, min_docs: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Insert all documents into a fresh index and drop their frequent lines.

    The frequent part of the exact table is stored, so the filters and the
    exact join see one table.
    """
    frequent = stored(reference_counts(docs, text_col).filter(F.col("n") >= min_docs), "lines")
    return drop_frequent_lines(docs, frequent, build_filters(frequent), id_col, text_col)
