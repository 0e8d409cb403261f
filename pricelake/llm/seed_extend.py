"""Substring dedup by seed and extend.

Seeds are winnowed anchors: k-grams of words such that every window of
``width`` words holds one. Documents are joined on the anchors that occur in
several documents. From an anchor a match extends both ways: first over the
whole run of windows around it (occurrences whose runs are equal word for word
match as one), then, where runs around one anchor differ, window by
window. Matched windows that touch make up the maximal repeats, which are at least
``width`` words long by construction.

A word goes if one of its windows also starts in a document with a smaller id.
Windows are judged on the input.

Hot passages: seeds, runs and windows are aggregated before each shuffle, the joins
have one row per key on their right side, and no pair of occurrences is ever formed.

Defined results: a null, empty or blank text has no words; a repeated row gives
equal results and never removes its twin (its id is not smaller); a row
whose id is null neither removes nor loses words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, arrow_rows, attach, keyed, pieces, stored
from pricelake.llm.repeats import STEP, Symbols, anchored_runs, covered, run_span, span_arrays, with_spans
from pricelake.llm.symbols import BASE_B, RunHash

#: Words of a seed.
SEED_WORDS = 4


def _window_hashes(docs: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """(key, pos, w1, w2): every window of the given runs with its 128-bit hash."""
    listed = runs.groupBy(KEY_ID, KEY_HASH).agg(F.collect_list(F.struct("first", "count")).alias("runs"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", STEP):
            s = Symbols(batch.column(1), "words")
            runs = batch.column(3)
            first, count = (runs.flatten().field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(2))
            doc = np.repeat(np.arange(batch.num_rows), runs.value_lengths().to_numpy())
            row = np.repeat(np.arange(len(first)), count)
            pos = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = pos + s.first[doc[row]]
            take = pa.array(doc[row])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(2).take(take), pa.array(pos.astype(np.int32)),
                 *[pa.array(RunHash(s.hashes, *b).of(at, at + width).view(np.int64)) for b in ((), (BASE_B,))]],
                names=[KEY_ID, KEY_HASH, "pos", "w1", "w2"])

    schema = T.StructType([docs.schema[KEY_ID], *T.StructType.fromDDL(f"{KEY_HASH} long, pos int, w1 long, w2 long").fields])
    return attach(docs, listed, "inner").mapInArrow(expand, schema)


def repeat_spans(slim: DataFrame, width: int, seed_words: int = SEED_WORDS) -> DataFrame:
    """(key, start, end): spans of words that an earlier document repeats; they may overlap."""
    runs = anchored_runs(slim.filter(F.col(KEY_ID).isNotNull()), "words", seed_words, width).drop("shift")
    # Aggregates are stored before a join needs them: the join then reads a shuffle of its own on either side,
    # and Spark can split the partition of a hot key.
    seeds = runs.groupBy("anchor").agg(F.min(KEY_ID).alias("lo"), F.max(KEY_ID).alias("hi")).filter("lo < hi").select("anchor")
    runs = stored(runs.join(stored(seeds, "seeds"), "anchor"), "seed-runs")
    segments = stored(runs.groupBy("anchor", "segment").agg(F.min(KEY_ID).alias("lo")), "seed-segments")
    shapes = stored(segments.groupBy("anchor").agg((F.count(F.lit(1)) > 1).alias("several")), "seed-shapes")
    judged = runs.join(stored(segments.join(shapes, "anchor"), "segment-shapes"), ["anchor", "segment"])
    # A run that an earlier document has whole goes whole; the earliest one of each shape is looked at window by window.
    judged = stored(judged.filter((F.col(KEY_ID) > F.col("lo")) | F.col("several")).select(
        KEY_ID, KEY_HASH, "first", "count", (F.col(KEY_ID) > F.col("lo")).alias("whole")), "judged-runs")
    windows = stored(_window_hashes(slim, judged.filter(~F.col("whole")), width), "run-windows")
    earliest = windows.groupBy("w1", "w2").agg(F.min(KEY_ID).alias("lo"), F.max(KEY_ID).alias("hi")).filter("lo < hi").select("w1", "w2", "lo")
    later = windows.join(stored(earliest, "earliest"), ["w1", "w2"]).filter(F.col(KEY_ID) > F.col("lo"))
    return judged.filter("whole").select(KEY_ID, KEY_HASH, *run_span(width)).unionByName(
        later.select(KEY_ID, KEY_HASH, F.col("pos").alias("start"), (F.col("pos") + F.lit(width)).alias("end")))


def dedup_substrings(docs: DataFrame, width: int = 13, seed_words: int = SEED_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, text): the words kept, joined by one space."""
    arrow_rows(docs.sparkSession)
    slim = keyed(docs, id_col, text_col)
    spans = stored(repeat_spans(slim, width, seed_words), "repeat-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", STEP):
            s = Symbols(batch.column(1), "words")
            total, gone, kept = np.diff(s.first), [], []
            for d, spans in enumerate(span_arrays(batch.column(3))):
                out = covered(spans, int(total[d]))
                keep = np.flatnonzero(~out) + s.first[d]
                gone.append(int(out.sum()))
                kept.append(b" ".join([s.raw[a:b].tobytes() for a, b in zip(s.starts[keep].tolist(), s.ends[keep].tolist(), strict=True)]).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=names)

    names = [KEY_ID, "n_words", "n_removed", "text"]
    schema = T.StructType([slim.schema[KEY_ID], *T.StructType.fromDDL("n_words long, n_removed long, text string").fields])
    return with_spans(slim, spans).select(KEY_ID, "text", KEY_HASH, "spans").mapInArrow(cut, schema).withColumnRenamed(KEY_ID, id_col)
