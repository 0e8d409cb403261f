"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A file is a row of frames; a frame holds one sequence:

    uint64 length | uint32 masked CRC-32C of the length | payload | uint32 masked CRC-32C of the payload

The payload is a header (int64 id, uint32 flags, uint32 number of ids) and the
ids, all little-endian; flag 1 says that the id is null, flag 2 that ids take
two bytes instead of four (a tokenizer whose largest id fits).

Documents are dealt out in ranges of ascending id, so files follow each other
as their ranges do. Each task writes files of its own under names no other
attempt uses and returns one index row a record; the index is Parquet, written
by Spark, so it lists exactly the records of the attempts that counted. Files
of lost attempts are never read, and are removed when the index is complete.

Null text is an empty sequence (the end id alone). A null id sorts first.
Repeated ids and rows each keep their own record. An empty table gives an
index without rows.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.checksums import crc32c, masked
from pricelake.llm.common import arrow_rows, pieces
from pricelake.llm.files import open_store, ragged

#: A file is closed once it holds so many bytes.
FILE_BYTES = 128 << 20
#: Bytes asked of the file system at once.
READ_BYTES = 4 << 20
#: Words a Python worker remembers, and characters they may hold together, before its memory starts anew.
REMEMBERED_WORDS, REMEMBERED_CHARS = 2_000_000, 32 << 20
#: Files a task of a shuffled read keeps open.
OPEN_FILES = 32

NULL_ID, TWO_BYTES = 1, 2
LENGTH, CHECK, HEADER = "<Q", "<I", "<qII"
LENGTH_BYTES, CHECK_BYTES, HEADER_BYTES = map(struct.calcsize, (LENGTH, CHECK, HEADER))
FRAME_BYTES = LENGTH_BYTES + 2 * CHECK_BYTES

INDEX = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("file", T.StringType()),
                      T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("n_tokens", T.LongType())])


class Corrupt(ValueError):
    """A record whose length or content does not match its checksum, or that ends early."""


# --- encoding

class Encoder:
    """Token ids of texts by a ``tokenizers`` tokenizer, given as JSON.

    ``by_word`` encodes distinct stretches between blanks (space, tab, line
    feed) once and strings their ids together. It suits tokenizers that drop white space and
    let neither normalisation nor merges reach across it; others need the whole text at once.
    """

    def __init__(self, tokenizer_json: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer, self.by_word = Tokenizer.from_str(tokenizer_json), by_word
        self.forget()

    def forget(self) -> None:
        self.known: defaultdict[str, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.chars = self.used = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int64)

    def _listed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum())), size

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of ``words``, the latest to be numbered."""
        ids, size = self._listed(words)
        first, end = len(self.known) - len(words), self.used + len(ids)
        for name, need in (("flat", end), ("begin", len(self.known)), ("size", len(self.known))):
            old = getattr(self, name)
            if need > len(old):
                grown = np.zeros(max(need, 2 * len(old)), old.dtype)
                grown[: len(old)] = old
                setattr(self, name, grown)
        self.flat[self.used: end] = ids
        self.begin[first: len(self.known)] = self.used + np.cumsum(size) - size
        self.size[first: len(self.known)] = size
        self.chars += sum(map(len, words))
        self.used = end

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in turn, number of ids of each text)."""
        if not self.by_word:
            return self._listed(texts)
        if len(self.known) > REMEMBERED_WORDS or self.chars > REMEMBERED_CHARS:
            self.forget()
        split = [t.replace("\n", " ").replace("\t", " ").split(" ") for t in texts]
        count, before = [len(words) for words in split], len(self.known)
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), np.int64, sum(count))
        if new := len(self.known) - before:
            self._learn([*islice(reversed(self.known), new)][::-1])
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *count])]
        return self.flat[ragged(self.begin[at], size)], np.diff(ends)


#: The last encoder of this Python worker: the next task of the same tokenizer goes on with its memory.
_LAST: list[tuple[tuple[str, bool], Encoder]] = []


def encoder_of(tokenizer_json: str, by_word: bool) -> Encoder:
    if not _LAST or _LAST[0][0] != (tokenizer_json, by_word):
        _LAST[:] = [((tokenizer_json, by_word), Encoder(tokenizer_json, by_word))]
    return _LAST[0][1]


# --- frames

def frames(doc_ids: list[int | None], ids: np.ndarray, size: np.ndarray, two_bytes: bool) -> tuple[bytearray, np.ndarray]:
    """(the frames of some sequences in turn, the length of each payload)."""
    raw = ids.astype("<u2" if two_bytes else "<u4").tobytes()
    width = 2 if two_bytes else 4
    length = HEADER_BYTES + width * size
    begin = np.cumsum(length + FRAME_BYTES) - length - FRAME_BYTES
    out = bytearray(int((length + FRAME_BYTES).sum()))
    place = 0
    flags = TWO_BYTES * two_bytes
    for i, b, n, m in zip(doc_ids, begin.tolist(), length.tolist(), size.tolist(), strict=True):
        struct.pack_into(LENGTH, out, b, n)
        b += LENGTH_BYTES + CHECK_BYTES
        struct.pack_into(HEADER, out, b, i or 0, flags | (NULL_ID if i is None else 0), m)
        out[b + HEADER_BYTES: b + n] = raw[place: place + width * m]
        place += width * m
    data = np.frombuffer(out, np.uint8)
    heads = masked(crc32c(data, begin, np.full(len(begin), LENGTH_BYTES)))
    bodies = masked(crc32c(data, begin + LENGTH_BYTES + CHECK_BYTES, length))
    del data
    for b, n, h, c in zip(begin.tolist(), length.tolist(), heads.tolist(), bodies.tolist(), strict=True):
        struct.pack_into(CHECK, out, b + LENGTH_BYTES, h)
        struct.pack_into(CHECK, out, b + LENGTH_BYTES + CHECK_BYTES + n, c)
    return out, length


def verify(buffer: bytes, begin: np.ndarray, length: np.ndarray, name: str) -> None:
    """Fail unless all frames that begin at ``begin`` match their checksums."""
    data = np.frombuffer(buffer, np.uint8)

    def stored(at: np.ndarray) -> np.ndarray:
        return data[at[:, None] + np.arange(4)].astype(np.uint32) @ (1 << np.arange(0, 32, 8)).astype(np.uint32)

    body = begin + LENGTH_BYTES + CHECK_BYTES
    good = stored(begin + LENGTH_BYTES) == masked(crc32c(data, begin, np.full(len(begin), LENGTH_BYTES)))
    good &= stored(body + length) == masked(crc32c(data, body, length))
    if not good.all():
        raise Corrupt(f"{name}: a record does not match its checksum")


def unpacked(buffer: bytes, begin: int) -> tuple[int | None, bytes]:
    """(doc_id, ids as unsigned 32-bit integers) of the frame at ``begin``."""
    at = begin + LENGTH_BYTES + CHECK_BYTES
    doc_id, flags, n = struct.unpack_from(HEADER, buffer, at)
    ids = np.frombuffer(buffer, "<u2" if flags & TWO_BYTES else "<u4", n, at + HEADER_BYTES)
    return None if flags & NULL_ID else doc_id, ids.astype("<u4").tobytes()


def file_frames(stream, name: str) -> Iterator[tuple[bytes, np.ndarray]]:
    """(buffer, where its frames begin) for all verified frames of an open file, a few megabytes at a time."""
    rest, ended = b"", False
    want = READ_BYTES
    while rest or not ended:
        got = stream.read(max(READ_BYTES, want - len(rest)))
        ended = not got
        rest += got
        begin, length, at = [], [], 0
        while at + LENGTH_BYTES + CHECK_BYTES <= len(rest):
            (n,) = struct.unpack_from(LENGTH, rest, at)
            want = n + FRAME_BYTES
            if at + want > len(rest):
                # A damaged length must not make us wait for bytes that cannot come.
                head = np.frombuffer(rest, np.uint8, LENGTH_BYTES, at)
                if struct.unpack_from(CHECK, rest, at + LENGTH_BYTES)[0] != masked(crc32c(head, [0], [LENGTH_BYTES]))[0]:
                    raise Corrupt(f"{name}: a record's length does not match its checksum")
                break
            begin.append(at)
            length.append(n)
            at += want
        if begin:
            verify(rest, np.array(begin), np.array(length), name)
            yield rest, np.array(begin)
        elif ended and rest:
            raise Corrupt(f"{name}: the file ends within a record")
        rest = rest[at:]


# --- jobs

def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id",
                  text_col: str = "text", by_word: bool = False) -> None:
    """Encode ``docs`` and write ``path/data`` (record files) and ``path/index`` (Parquet: doc_id, file, offset, length, n_tokens).

    Each sequence ends with ``end_id``. ``path`` must be a new folder that all
    executors see. Ids must be integers. See ``Encoder`` for ``by_word``.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        tokenizer = f.read()
    two_bytes = max(Encoder(tokenizer, by_word).tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16
    sent = spark.sparkContext.broadcast(tokenizer)
    place = f"{path.rstrip('/')}/data"
    store, folder = open_store(place)
    store.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(sent.value, by_word)
        files, top = open_store(place)
        out, name, offset = None, "", 0
        try:
            for batch in pieces(batches, "text"):
                ids, size = encoder.encode([t or "" for t in batch.column(1).to_pylist()])
                ids = np.insert(ids, np.cumsum(size), np.uint32(end_id))
                size = size + 1
                doc_ids = batch.column(0).to_pylist()
                data, length = frames(doc_ids, ids, size, two_bytes)
                if out is None:
                    name, offset = f"{uuid.uuid4().hex}.rec", 0
                    out = files.open_output_stream(f"{top}/{name}")
                out.write(data)
                begin = offset + np.cumsum(length + FRAME_BYTES) - length - FRAME_BYTES
                offset += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array([name] * len(size)), pa.array(begin), pa.array(length), pa.array(size)],
                    names=INDEX.fieldNames())
                if offset >= FILE_BYTES:
                    out.close()
                    out = None
        finally:
            if out is not None:
                out.close()

    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # The row number deals out repeated rows as well: no id is too frequent for a range.
    order = ["doc_id", "__row"]
    dealt = slim.withColumn("__row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.select("doc_id", "text").mapInArrow(write, INDEX).write.parquet(f"{path.rstrip('/')}/index")
    _drop_unlisted(spark, path)


def _drop_unlisted(spark: SparkSession, path: str) -> None:
    """Remove the files of attempts that did not count (names only; one a partition or 128 MB)."""
    listed = {r[0] for r in record_index(spark, path).select("file").distinct().toLocalIterator()}
    store, folder = open_store(f"{path.rstrip('/')}/data")
    for info in store.get_file_info(pafs.FileSelector(folder)):
        if info.type == pafs.FileType.File and info.base_name not in listed:
            store.delete_file(info.path)


def record_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: where each record lies."""
    return spark.read.schema(INDEX).parquet(f"{path.rstrip('/')}/index")


def record_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, records, n_tokens, start) of each file; ``start`` counts the ids of all files before it, in order of their ids."""
    each = record_index(spark, path).groupBy("file").agg(
        F.count("*").alias("records"), F.sum("n_tokens").alias("n_tokens"),
        F.count(F.when(F.col("doc_id").isNull(), 1)).alias("__nulls"),
        F.min("doc_id").alias("__least"), F.max("doc_id").alias("__most"))
    # Files hold ascending ranges of ids. Among files of one id only, the order is free but fixed.
    key = [(F.col("__nulls") == 0), F.col("__least").asc_nulls_first(), F.col("__most").asc_nulls_first(), "file"]
    before = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)  # a row a file, not a document
    return each.select("file", "records", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))


def _batch(rows: list[tuple], names: list[str], as_array: bool) -> pa.RecordBatch:
    doc_id, start, size, ids = zip(*rows, strict=True)
    if as_array:
        ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        column = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), "<u4").astype(np.int64))
    else:
        column = pa.array(ids, pa.binary())
    whole = {"doc_id": pa.array(doc_id, pa.int64()), "start": pa.array(start, pa.int64()), "n_tokens": pa.array(size, pa.int64()), "ids": column}
    return pa.RecordBatch.from_arrays([whole[n] for n in names], names=names)


def _schema(names: list[str], as_array: bool) -> T.StructType:
    ids = T.ArrayType(T.LongType()) if as_array else T.BinaryType()
    return T.StructType([T.StructField(n, ids if n == "ids" else T.LongType()) for n in names])


def read_records(spark: SparkSession, path: str, as_array: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all records, each file read from front to end and verified.

    ``ids`` is an array, or without ``as_array`` the ids as little-endian
    unsigned 32-bit integers in a binary value. ``start`` counts the ids of all records before it in ascending order of
    ids. A record that does not match its checksums fails the read.
    """
    place = f"{path.rstrip('/')}/data"
    files = record_files(spark, path)
    names = ["doc_id", "start", "n_tokens", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(place)
        for batch in batches:
            for name, records, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = 0
                with store.open_input_stream(f"{folder}/{name}") as stream:
                    for buffer, begin in file_frames(stream, name):
                        rows = []
                        for b in begin.tolist():
                            doc_id, ids = unpacked(buffer, b)
                            rows.append((doc_id, start, len(ids) // 4, ids))
                            start += len(ids) // 4
                        found += len(rows)
                        yield _batch(rows, names, as_array)
                if found != records:
                    raise Corrupt(f"{name}: {found} records, {records} in the index")

    parts = max(1, files.count())
    return files.select("file", "records", "start").repartition(parts, "file").mapInArrow(read, _schema(names, as_array))


def read_shuffled(spark: SparkSession, path: str, seed: int, as_array: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids) of all records in an order drawn by ``seed``: each is read at its offset, for one epoch of training."""
    place = f"{path.rstrip('/')}/data"
    mixed = record_index(spark, path).withColumn("__at", F.xxhash64(F.lit(seed), "file", "offset"))
    names = ["doc_id", "n_tokens", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = open_store(place)
        opened: dict = {}
        for batch in batches:
            rows = []
            held = 0
            for name, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name not in opened:
                    if len(opened) >= OPEN_FILES:
                        opened.pop(next(iter(opened))).close()
                    opened[name] = store.open_input_file(f"{folder}/{name}")
                buffer = opened[name].read_at(length + FRAME_BYTES, offset)
                if len(buffer) < length + FRAME_BYTES or struct.unpack_from(LENGTH, buffer, 0)[0] != length:
                    raise Corrupt(f"{name}: no record of {length} bytes at {offset}")
                verify(buffer, np.array([0]), np.array([length]), name)
                doc_id, ids = unpacked(buffer, 0)
                rows.append((doc_id, 0, len(ids) // 4, ids))
                held += len(ids)
                if held > READ_BYTES:
                    yield _batch(rows, names, as_array)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, names, as_array)
        for stream in opened.values():
            stream.close()

    return mixed.repartitionByRange("__at").sortWithinPartitions("__at").select("file", "offset", "length").mapInArrow(read, _schema(names, as_array))

