"""What the two repeat finders share: winnowed anchors, repeated runs of windows, removal spans.

A window is ``width`` consecutive symbols (bytes or words) of one document.
Its anchor is its leftmost k-gram of least hash, so equal windows have equal
anchors at equal offsets. Consecutive windows with one anchor form a run; the
run's text is its segment. Only anchors that occur again can lie in a repeated
window, so all others are dropped after one aggregation.

Hashes have 64 bits; equality of segments is judged on the anchor's and the
segment's hash together (128 bits, independent polynomials).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, attach, pieces
from pricelake.llm.symbols import BASE_A, RunHash, mix, text_buffer, window_runs, word_hashes, word_spans

#: Text that is hashed at once; byte symbols take about a hundred times their size in numpy arrays.
STEP = 1 << 20

_BYTE_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE_A))


class Symbols:
    """The symbols of an Arrow batch of texts: ``bytes`` or ``words``."""

    def __init__(self, texts: pa.Array, kind: str):
        self.raw, self.offsets = text_buffer(texts)
        if kind == "bytes":
            self.starts, self.first, self.hashes = None, self.offsets, _BYTE_SYMBOLS[self.raw]
        else:
            self.starts, self.ends, self.first = word_spans(self.raw, self.offsets)
            self.hashes = word_hashes(self.raw, self.starts, self.ends)


def anchored_runs(docs: DataFrame, kind: str, k: int, width: int) -> DataFrame:
    """(key, anchor, segment, first, count, shift) of keyed documents: one row per run of windows.

    ``first`` is the run's first window (symbol number in the document), ``shift`` the anchor's place in the segment.
    """

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", STEP):
            s = Symbols(batch.column(1), kind)
            doc, first, count, anchor, place = window_runs(s.hashes, s.first, k, width)
            if len(doc):
                segment = RunHash(s.hashes).of(first, first + count + width - 1)
                take = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(2).take(take), pa.array(anchor.view(np.int64)),
                     pa.array(segment.view(np.int64)), pa.array((first - s.first[doc]).astype(np.int32)),
                     pa.array(count.astype(np.int32)), pa.array((place - first).astype(np.int32))],
                    names=[KEY_ID, KEY_HASH, "anchor", "segment", "first", "count", "shift"])

    schema = T.StructType([docs.schema[KEY_ID], *T.StructType.fromDDL(
        f"{KEY_HASH} long, anchor long, segment long, first int, count int, shift int").fields])
    return docs.mapInArrow(winnow, schema)


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Keyed documents with ``spans``, an array of (start, end) from the rows (key, start, end); null where none."""
    listed = spans.groupBy(KEY_ID, KEY_HASH).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return attach(docs, listed)


def span_arrays(spans: pa.Array) -> Iterator[np.ndarray]:
    """The spans of each row as an array of merged, sorted (start, end); touching spans become one."""
    flat = spans.flatten()
    start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
    lengths = spans.value_lengths().fill_null(0).to_numpy()
    at = 0
    for n in lengths.tolist():
        a, b = start[at: at + n], end[at: at + n]
        at += n
        if not n:
            yield np.zeros((0, 2), dtype=np.int64)
            continue
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        new = np.ones(n, dtype=bool)
        new[1:] = a[1:] > b[:-1]
        head = np.flatnonzero(new)
        yield np.stack([a[head], b[np.append(head[1:] - 1, n - 1)]], axis=1)


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Mask of the symbols inside the spans."""
    mark = np.zeros(n + 1, dtype=np.int64)
    np.add.at(mark, spans[:, 0], 1)
    np.add.at(mark, spans[:, 1], -1)
    return np.cumsum(mark[:-1]) > 0


def run_span(width: int) -> list[Column]:
    """(start, end) of all symbols of a run of windows."""
    return [F.col("first").alias("start"), (F.col("first") + F.col("count") + F.lit(width - 1)).alias("end")]
