"""Benchmark decontamination by a prefix-filtered set join.

Every benchmark item gives windows of ``window`` consecutive words (a shorter
item is one window). A document contains a window only if it contains all its
shingles, so, at a containment of one, a single shingle per window is a
sufficient join prefix. Shingles are ordered by rarity over all documents, and
each window's prefix is its rarest shingle:

1. count the benchmark's shingles over all documents;
2. choose each window's prefix shingle, with its offset in the window;
3. probe: document positions that hold a prefix shingle, within the length and
   positional bounds of the windows with that prefix, become candidates with the
   words around them;
4. join the candidates with the windows by shingle and verify word by word.

Shingle hashes only choose candidates; every hit is verified on its words.
What tasks get of the benchmark are sorted hash arrays, in blocks of windows of
a fixed size, so a benchmark of any size fits; documents are read once per
block and step and never shuffled as text.

Defined results: words are lower-cased (A-Z); a null or empty text has none;
an item without words has no window; repeated documents repeat, with equal
results; repeated items count as one id each; ids may be null (a null item id is
not listed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, arrow_rows, attach, keyed, pieces, stored, with_key
from pricelake.llm.symbols import ALNUM, LOWER, RunHash, text_buffer, word_hashes, word_spans
from pricelake.operators.joins import maybe_broadcast

#: Words of a shingle (a shorter window is its own shingle).
SHINGLE = 3
#: Distinct windows whose shingles are sent to the tasks at once (at most 8 bytes a shingle).
BLOCK_WINDOWS = 500_000
#: Windows up to this size are joined to the candidates by broadcast.
BROADCAST_BYTES = 32 << 20


class _Words:
    """The words of an Arrow batch of texts and the hashes of their shingles."""

    def __init__(self, texts: pa.Array):
        raw, offsets = text_buffer(texts)
        self.raw = LOWER[raw]
        self.starts, self.ends, self.first = word_spans(self.raw, offsets, ALNUM)
        self.run = RunHash(word_hashes(self.raw, self.starts, self.ends)) if len(self.starts) else None
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions, signed hashes) of the shingles of ``size`` words that lie in one document."""
        at = np.arange(max(0, len(self.starts) - size + 1))
        at = at[self.doc[at] == self.doc[at + size - 1]] if len(at) else at
        return at, self.run.of(at, at + size).view(np.int64) if len(at) else np.zeros(0, np.int64)

    def text(self, start: int, end: int) -> list[str]:
        return [self.raw[a:b].tobytes().decode() for a, b in zip(self.starts[start:end], self.ends[start:end], strict=True)]


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words, shingles): each distinct window of each item; shingles are (offset, hash) pairs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            words = _Words(batch.column(1))
            row, texts, marks = [], [], []
            for d in range(batch.num_rows):
                a, b = int(words.first[d]), int(words.first[d + 1])
                width = min(window, b - a)
                size = min(SHINGLE, width)
                for s in range(a, b - width + 1 if width else a):
                    at = np.arange(s, s + width - size + 1)
                    row.append(d)
                    texts.append(words.text(s, s + width))
                    marks.append([{"offset": i, "shingle": int(h)} for i, h in enumerate(words.run.of(at, at + size).view(np.int64))])
            if row:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(texts, pa.list_(pa.string())),
                     pa.array(marks, pa.list_(pa.struct([("offset", pa.int32()), ("shingle", pa.int64())])))],
                    names=["item_id", "words", "shingles"])

    slim = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text"))
    schema = T.StructType([slim.schema["item_id"], *T.StructType.fromDDL(
        "words array<string>, shingles array<struct<offset:int,shingle:bigint>>").fields])
    return slim.mapInArrow(cut, schema).distinct()


def _counted(texts: DataFrame, sizes: list[int], hashes: np.ndarray) -> DataFrame:
    """(shingle, n): how often the documents hold each of the sorted ``hashes``."""
    sent = texts.sparkSession.sparkContext.broadcast(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        total = np.zeros(len(known), dtype=np.int64)
        for batch in pieces(batches, "text"):
            words = _Words(batch.column(0))
            for size in sizes:
                found = words.shingles(size)[1]
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                total += np.bincount(place[known[place] == found], minlength=len(known))
        some = np.flatnonzero(total)
        if len(some):
            yield pa.RecordBatch.from_arrays([pa.array(known[some]), pa.array(total[some])], names=["shingle", "n"])

    return texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


_CANDIDATES = "array<struct<shingle:bigint,pos:int,from:int,words:array<string>>>"


def _probed(docs: DataFrame, sizes: list[int], bounds: np.ndarray, window: int) -> DataFrame:
    """(key, n_words, candidates) per document. ``bounds`` is (shingle, least offset, least rest) sorted by shingle."""
    sent = docs.sparkSession.sparkContext.broadcast(bounds)
    kind = pa.list_(pa.struct([("shingle", pa.int64()), ("pos", pa.int32()), ("from", pa.int32()), ("words", pa.list_(pa.string()))]))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, before, after = sent.value
        for batch in pieces(batches, "text"):
            words = _Words(batch.column(1))
            out: list[list[dict] | None] = [None] * batch.num_rows
            for size in sizes if len(known) else []:
                at, found = words.shingles(size)
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                doc = words.doc[at] if len(at) else at
                # Length and position: a window with this prefix must lie inside the document.
                fits = (known[place] == found) & (at - before[place] >= words.first[doc]) & (at + after[place] <= words.first[doc + 1])
                for p, h in zip(at[fits].tolist(), found[fits].tolist(), strict=True):
                    d = int(words.doc[p])
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    begin, until = max(a, p - window + 1), min(b, p + window)
                    if out[d] is None:
                        out[d] = []
                    out[d].append({"shingle": h, "pos": p - a, "from": begin - a, "words": words.text(begin, until)})
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.diff(words.first), pa.int64()), pa.array(out, kind)],
                names=[KEY_ID, KEY_HASH, "n_words", "candidates"])

    schema = T.StructType([docs.schema[KEY_ID], *T.StructType.fromDDL(
        f"{KEY_HASH} long, n_words long, candidates {_CANDIDATES}").fields])
    return docs.mapInArrow(probe, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_hit, items) per document: words, words inside benchmark windows, sorted ids of the items found."""
    return _found(docs, benchmark, window, id_col, text_col).select(F.col(KEY_ID).alias(id_col), "n_words", "n_hit", "items")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a window of an item; all columns stay."""
    leaks = _found(docs, benchmark, window, id_col, text_col).filter("n_hit > 0").select(KEY_ID, KEY_HASH).distinct()
    return attach(with_key(docs, id_col, text_col), leaks, "left_anti").drop(KEY_ID, KEY_HASH)


def _found(docs: DataFrame, benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(key, n_words, n_hit, items) per document."""
    spark = docs.sparkSession
    arrow_rows(spark)
    slim = keyed(docs, id_col, text_col)
    pairs = stored(benchmark_windows(benchmark, window), "windows")
    windows = pairs.groupBy("words").agg(F.first("shingles").alias("shingles"))
    blocks = max(1, -(-windows.count() // BLOCK_WINDOWS))
    facts, base = [], None
    for k in range(blocks):
        block = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        each = block.select("words", F.explode("shingles").alias("s")).select("words", "s.offset", "s.shingle")
        sizes = sorted({min(SHINGLE, r[0]) for r in block.select(F.size("words")).distinct().collect()})
        hashes = np.sort(each.select("shingle").distinct().toArrow().column(0).to_numpy())
        if len(hashes):
            rarity = _counted(slim.select("text"), sizes, hashes)
            # The rarest shingle is the window's prefix; one that no document holds rules the window out.
            prefix = (each.join(rarity, "shingle", "left").groupBy("words").agg(
                F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("p"))
                .filter("p.n > 0").select("words", "p.shingle", "p.offset", F.size("words").alias("width")))
            prefix = stored(prefix, "prefix")
            least = prefix.groupBy("shingle").agg(F.min("offset").alias("a"), F.min(F.col("width") - F.col("offset")).alias("b"))
            table = least.orderBy("shingle").toArrow()
            bounds = np.array([table.column(c).to_numpy() for c in ("shingle", "a", "b")], dtype=np.int64)
        else:
            prefix, bounds = None, np.zeros((3, 0), dtype=np.int64)
        probed = stored(_probed(slim, sizes, bounds, window), "probed")
        base = probed.select(KEY_ID, KEY_HASH, "n_words") if base is None else base
        if prefix is None:
            continue
        found = probed.filter(F.col("candidates").isNotNull()).select(KEY_ID, KEY_HASH, F.explode("candidates").alias("c"))
        start = F.col("c.pos") - F.col("offset")
        hit = (found.join(maybe_broadcast(prefix, BROADCAST_BYTES), F.col("c.shingle") == F.col("shingle"))
               .filter((start >= F.col("c.from")) & (start + F.col("width") <= F.col("c.from") + F.size("c.words")))
               .filter(F.slice("c.words", start - F.col("c.from") + 1, F.col("width")) == F.col("words"))
               .select(KEY_ID, KEY_HASH, start.alias("start"), "width", "words"))
        facts.append(hit)
    if not facts:
        return base.select(KEY_ID, KEY_HASH, "n_words", F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items"))
    hits = facts[0]
    for more in facts[1:]:
        hits = hits.unionByName(more)
    hits = stored(hits, "hits")
    # Spans of a document in order; each adds the words past the furthest end so far.
    spans = hits.groupBy(KEY_ID, KEY_HASH).agg(F.sort_array(F.collect_set(F.struct("start", "width"))).alias("spans"))
    covered = spans.select(KEY_ID, KEY_HASH, F.expr(
        "aggregate(spans, named_struct('n', 0L, 'end', 0L), (acc, s) -> named_struct("
        "'n', acc.n + greatest(0L, s.start + s.width - greatest(acc.end, cast(s.start as bigint))), "
        "'end', greatest(acc.end, cast(s.start + s.width as bigint))), acc -> acc.n)").alias("n_hit"))
    held = pairs.filter(F.col("item_id").isNotNull()).select("words", F.col("item_id").cast("string").alias("item"))
    items = (hits.select(KEY_ID, KEY_HASH, "words").distinct().join(maybe_broadcast(held, BROADCAST_BYTES), "words")
             .groupBy(KEY_ID, KEY_HASH).agg(F.sort_array(F.collect_set("item")).alias("items")))
    out = attach(attach(base, covered), items)
    return out.select(KEY_ID, KEY_HASH, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))
