"""Suffix-array dedup of byte strings, built column by column over many documents.

The collection is cut at winnowed anchors (``repeats``): windows of ``width``
bytes with one anchor form a segment, and segments whose anchors are equal are
lined up on it. Equal windows lie at equal offsets from equal anchors, so each
anchor's segments are a small collection of their own, and a repeat never
crosses two collections.

Each collection's suffix order is built from the last column to the first:
every round puts one symbol of each document's segment in front of the
suffixes sorted so far. As in any Burrows-Wheeler transform, the new order is
a stable sort of the symbols read in the old order, and the common prefix of two
new neighbours is one more than the least common prefix between their old
places. After each round, neighbours with a common prefix of ``width`` or more
are windows that occur twice. Collections arrive anchor by anchor from Spark's
sorted shuffle files and are worked through in sequence, many small ones side by side.

Segments that are equal as a whole are counted before any of this and take
part once, so copies cost nothing; a collection of more than ``largest``
distinct segments (a passage with that many different surroundings) is resolved
by counting hashes of its windows instead, with equal results, since one task should not hold it.

A byte goes if a ``width``-byte string that covers it also starts elsewhere, in
the same document or another. Overlaps count; strings are judged on the input.

Defined results: a null or empty text has no bytes; of repeated rows each
byte in a long enough text repeats, so all of it goes; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, arrow_rows, attach, keyed, pieces, stored
from pricelake.llm.repeats import STEP, Symbols, anchored_runs, run_span, span_arrays, with_spans
from pricelake.llm.symbols import BASE_B, RunHash

#: Bytes of an anchor.
ANCHOR_BYTES = 32
#: Distinct segments of one anchor that a task holds at most.
LARGEST = 40_000
#: Segments that are sorted side by side.
ROWS = 16_000


def repeated_windows(group: np.ndarray, shift: np.ndarray, segments: list[bytes], width: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of each window that another segment of its group has at the same offset from the anchor.

    ``group`` is sorted; ``shift`` is the anchor's place in each segment.
    """
    m = len(segments)
    left = width - anchor  # a window starts at most so far before its anchor
    columns = left + width
    length = np.array([len(s) for s in segments], dtype=np.int64)
    begin = left - shift
    matrix = np.full((m, columns), 256, dtype=np.int16)  # 256: outside the segment, equal to nothing
    column = np.arange(columns)
    matrix[(column >= begin[:, None]) & (column < (begin + length)[:, None])] = np.frombuffer(b"".join(segments), dtype=np.uint8)
    by_column = np.ascontiguousarray(matrix.T)
    number = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]])).astype(np.int64) * 512
    order = np.arange(m)
    common = np.zeros(m + 1, dtype=np.int32)  # of each row with the one before it; one spare entry
    rows, places = [], []
    for j in range(columns - 1, -1, -1):
        key = number[order] + by_column[j][order]
        place = np.argsort(key, kind="stable")
        key = key[place]
        same = np.flatnonzero((key[1:] == key[:-1]) & (key[1:] % 512 != 256)) + 1
        new = np.zeros(m + 1, dtype=np.int32)
        if len(same):
            a, b = place[same - 1], place[same]
            least = common[b]
            far = np.flatnonzero(b - a > 1)
            if len(far):
                bounds = np.stack([a[far] + 1, b[far] + 1], axis=1).reshape(-1)
                least[far] = np.minimum.reduceat(common, bounds)[::2]
            new[same] = least + 1
        order, common = order[place], new
        if j <= left:
            hit = common[:m] >= width
            hit[:-1] |= hit[1:]
            found = order[hit]
            rows.append(found)
            places.append(j - begin[found])
    return np.concatenate(rows), np.concatenate(places)


def _segments(slim: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``wanted`` runs (key, first, count, shift, anchor, ...) with their bytes."""
    listed = wanted.groupBy(KEY_ID, KEY_HASH).agg(F.collect_list(F.struct("anchor", "first", "count", "shift", "single")).alias("runs"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", STEP):
            s = Symbols(batch.column(1), "bytes")
            runs = batch.column(3)
            anchor, first, count, shift, single = (runs.flatten().field(i) for i in range(5))
            doc = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
            at = first.to_numpy().astype(np.int64) + s.offsets[doc]
            raw = s.raw.tobytes()
            found = [raw[a:b] for a, b in zip(at.tolist(), (at + count.to_numpy() + width - 1).tolist(), strict=True)]
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(2).take(take), anchor, first, shift, single, pa.array(found, pa.binary())],
                names=[KEY_ID, KEY_HASH, "anchor", "first", "shift", "single", "bytes"])

    schema = T.StructType([slim.schema[KEY_ID], *T.StructType.fromDDL(
        f"{KEY_HASH} long, anchor long, first int, shift int, single boolean, bytes binary").fields])
    return attach(slim, listed, "inner").mapInArrow(read, schema)


def _sorted_spans(segments: DataFrame, width: int, anchor: int) -> DataFrame:
    """(key, start, end) of repeated windows of segments that occur once, collection by collection."""
    names = [KEY_ID, KEY_HASH, "start", "end"]

    def resolve(table: pa.Table) -> pa.RecordBatch:
        column = {c: table.column(c).combine_chunks() for c in table.schema.names}
        row, place = repeated_windows(column["anchor"].to_numpy(), column["shift"].to_numpy().astype(np.int64),
                                      column["bytes"].to_pylist(), width, anchor)
        single = column["single"].to_numpy(zero_copy_only=False)
        row, place = row[single[row]], place[single[row]]
        # Consecutive windows of a row make one span.
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        head = np.ones(len(row), dtype=bool)
        head[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
        begin = np.flatnonzero(head)
        last = np.append(begin[1:], len(row))[: len(begin)] - 1
        start = column["first"].to_numpy()[row[begin]] + place[begin]
        end = column["first"].to_numpy()[row[begin]] + place[last] + width
        take = pa.array(row[begin])
        return pa.RecordBatch.from_arrays([column[KEY_ID].take(take), column[KEY_HASH].take(take),
                                           pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=names)

    def sequence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < ROWS:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            mark = whole.column("anchor").to_numpy()
            cut = np.flatnonzero(mark[1:] != mark[:-1])
            if len(cut):  # the last anchor may go on
                yield resolve(whole.slice(0, int(cut[-1]) + 1))
                whole = whole.slice(int(cut[-1]) + 1)
            held, size = whole.to_batches(), whole.num_rows
        if size:
            yield resolve(pa.Table.from_batches(held))

    schema = T.StructType([segments.schema[KEY_ID], *T.StructType.fromDDL(f"{KEY_HASH} long, start int, end int").fields])
    return segments.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sequence, schema)


def _counted_spans(segments: DataFrame, width: int) -> DataFrame:
    """The same spans by counting window hashes, for anchors with very many distinct segments."""

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "bytes", STEP):
            texts = batch.column(batch.schema.get_field_index("bytes"))
            lengths = np.array([len(x) for x in texts.to_pylist()], dtype=np.int64)
            raw = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
            count = lengths - width + 1
            row = np.repeat(np.arange(len(lengths)), count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = place + (np.cumsum(lengths) - lengths)[row]
            take = pa.array(row)
            first = batch.column(batch.schema.get_field_index("first")).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array((first[row] + place).astype(np.int32)),
                 batch.column(batch.schema.get_field_index("single")).take(take),
                 *[pa.array(RunHash(raw, *b).of(at, at + width).view(np.int64)) for b in ((), (BASE_B,))]],
                names=[KEY_ID, KEY_HASH, "start", "single", "w1", "w2"])

    schema = T.StructType([segments.schema[KEY_ID], *T.StructType.fromDDL(
        f"{KEY_HASH} long, start int, single boolean, w1 long, w2 long").fields])
    windows = stored(segments.mapInArrow(expand, schema), "large-windows")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    return windows.filter("single").join(stored(twice, "twice"), ["w1", "w2"]).select(
        KEY_ID, KEY_HASH, "start", (F.col("start") + F.lit(width)).alias("end"))


def repeat_spans(slim: DataFrame, width: int, anchor: int = ANCHOR_BYTES, largest: int = LARGEST) -> DataFrame:
    """(key, start, end): spans of bytes whose windows start elsewhere too; they may overlap."""
    runs = anchored_runs(slim, "bytes", anchor, width)
    again = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor")
    # Aggregates are stored before a join needs them, so that Spark can split the partition of a hot key.
    runs = stored(runs.join(stored(again, "anchors"), "anchor"), "anchored-runs")
    one = F.struct(KEY_ID, KEY_HASH, "first", "count", "shift")
    segments = runs.groupBy("anchor", "segment").agg(F.count(F.lit(1)).alias("n"), F.first(one).alias("one"))
    segments = stored(segments, "segments")
    whole = runs.join(segments.filter("n > 1").select("anchor", "segment"), ["anchor", "segment"]).select(
        KEY_ID, KEY_HASH, *run_span(width))
    kinds = segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    wanted = segments.join(stored(kinds, "kinds"), "anchor").select(
        "one.*", "anchor", (F.col("n") == 1).alias("single"), (F.col("kinds") > largest).alias("large"))
    wanted = stored(wanted, "segments-wanted")
    parts = [whole]
    parts.append(_sorted_spans(stored(_segments(slim, wanted.filter("not large"), width), "segment-bytes"), width, anchor))
    if not wanted.filter("large").isEmpty():
        parts.append(_counted_spans(_segments(slim, wanted.filter("large"), width), width))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dedup_bytes(docs: DataFrame, width: int = 200, anchor: int = ANCHOR_BYTES, largest: int = LARGEST,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): the remaining bytes (they may end inside a character)."""
    arrow_rows(docs.sparkSession)
    slim = keyed(docs, id_col, text_col)
    spans = stored(repeat_spans(slim, width, anchor, largest), "byte-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            gone, number, kept = [], [], []
            for text, some in zip(texts, span_arrays(batch.column(3)), strict=True):
                gone.append(int((some[:, 1] - some[:, 0]).sum()))
                number.append(len(some))
                edges = [0, *some.reshape(-1).tolist(), len(text)]
                kept.append(b"".join([text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(number, pa.int64()), pa.array(kept, pa.binary())], names=names)

    names = [KEY_ID, "n_bytes", "n_removed", "n_spans", "kept"]
    schema = T.StructType([slim.schema[KEY_ID], *T.StructType.fromDDL("n_bytes long, n_removed long, n_spans long, kept binary").fields])
    return with_spans(slim, spans).select(KEY_ID, "text", KEY_HASH, "spans").mapInArrow(cut, schema).withColumnRenamed(KEY_ID, id_col)
