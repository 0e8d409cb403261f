"""SimHash near-dedup by tiled exact comparison.

Fingerprints: bit b of a text's fingerprint is 1 if it is set in over half of
the XXH64 hashes (seed 42) of its word shingles, repeats included. Two
fingerprints link at ``radius`` or fewer differing bits.

Distinct fingerprints are compared exactly in tiles with numpy exclusive-or
and bit counts. Two fingerprints within the radius agree on ``KEEP`` of
``radius + KEEP`` bit blocks, whichever bits differ; each such set of blocks
gives one bucket key, so every link lies inside a bucket. A bucket is sorted by
bit count and cut into tiles; a pair of tiles is compared only if their bit
counts come within the radius. A bucket of many tiles is dealt out by tile
pairs, so that no task gets a whole large bucket. Each comparison hands on a
spanning forest of its links; components follow by star contraction.

Defined results: a null, empty or blank text has the fingerprint zero and
links like any other; repeated rows repeat; a row whose id is null gets a
fingerprint and, as component, the least id that is not null among those it
reaches (null if there is none).
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import KEY_HASH, KEY_ID, arrow_rows, attach, keyed, pieces, stored, with_key
from pricelake.llm.components import components
from pricelake.llm.symbols import LOWER, text_buffer, word_spans

#: Blocks that two linked fingerprints must share; more blocks make smaller buckets and more copies.
KEEP = 2
#: Fingerprints of one tile.
TILE = 2048
#: The hash seed of the fingerprints.
SEED = 42

def fingerprints_of(texts: pa.Array, shingle: int) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    raw, offsets = text_buffer(texts)
    raw = LOWER[raw]
    starts, ends, first = word_spans(raw, offsets)
    joined, shift = _single_spaced(raw, starts, ends)
    hashes, owner = [], []
    digest = xxhash.xxh64_intdigest
    for d in range(len(offsets) - 1):
        a, b = int(first[d]), int(first[d + 1])
        if a == b:
            continue
        width = min(shingle, b - a)
        begin = shift[a: b - width + 1].tolist()
        until = (shift[a + width - 1: b] + (ends - starts)[a + width - 1: b]).tolist()
        hashes.extend([digest(joined[x:y], SEED) for x, y in zip(begin, until, strict=True)])
        owner.append((d, len(begin)))
    out = np.zeros(len(offsets) - 1, dtype=np.uint64)
    if not owner:
        return out
    docs, counts = (np.array(x) for x in zip(*owner, strict=True))
    edges = np.concatenate([[0], np.cumsum(counts)])
    all_hashes = np.array(hashes, dtype=np.uint64)
    for lo in _steps(edges, 1 << 17):
        hi = lo[1]
        part = all_hashes[edges[lo[0]]: edges[hi]]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, edges[lo[0]: hi] - edges[lo[0]], axis=0, dtype=np.int64)
        ones = (2 * sums > counts[lo[0]: hi, None]).astype(np.uint8)
        out[docs[lo[0]: hi]] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _single_spaced(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words joined by one space, and where each word starts in that."""
    length = ends - starts
    shift = np.cumsum(length + 1) - (length + 1)
    total = int(length.sum() + len(length))
    out = np.full(total, 0x20, dtype=np.uint8)
    inside = np.ones(total, dtype=bool)
    inside[shift + length] = False
    # Words are runs without blanks, so the non-blank bytes of the text in order are the words' bytes.
    mark = np.zeros(len(raw) + 1, dtype=np.int8)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    out[inside] = raw[np.cumsum(mark[:-1], dtype=np.int8).astype(bool)]
    return out.tobytes(), shift


def _steps(edges: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of documents with about ``size`` shingles (one document at least)."""
    begin = 0
    for i in range(1, len(edges)):
        if edges[i] - edges[begin] >= size or i == len(edges) - 1:
            yield begin, i
            begin = i


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, fp): the row key (id and text hash) and the fingerprint, a signed 64-bit number, of each row."""
    arrow_rows(docs.sparkSession)
    slim = keyed(docs, id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            marks = fingerprints_of(batch.column(1), shingle)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(marks.view(np.int64))],
                                             names=[KEY_ID, KEY_HASH, "fp"])

    schema = T.StructType([slim.schema[KEY_ID], T.StructField(KEY_HASH, T.LongType()), T.StructField("fp", T.LongType())])
    return slim.mapInArrow(compute, schema)


def _bucket_masks(radius: int, keep: int = KEEP) -> list[int]:
    """Bit masks of every choice of ``keep`` of ``radius + keep`` blocks of the 64 bits."""
    blocks = radius + keep
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(some) for some in itertools.combinations(masks, keep)]


class _Forest:
    """Union-find that tells which links join two trees."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _compare(left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple[int, int]]:
    """Index pairs within the radius; ``right`` None: pairs within ``left``."""
    own = right is None
    right = left if own else right
    rows = max(1, (1 << 20) // max(1, len(right)))
    for k in range(0, len(left), rows):
        near = np.bitwise_count(left[k: k + rows, None] ^ right[None, :]) <= radius
        a, b = np.nonzero(near)
        a += k
        if own:
            keep = a < b
            a, b = a[keep], b[keep]
        yield from zip(a.tolist(), b.tolist(), strict=True)


_EDGE = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def links(marks: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """(a, b): nodes of distinct fingerprints within the radius, a spanning forest of each comparison.

    ``marks`` has (fp, node), one row per fingerprint.
    """
    masks = _bucket_masks(radius)
    each = F.array(*[F.struct(F.lit(i).alias("band"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key"))
                     for i, m in enumerate(masks)])
    rows = marks.select("fp", "node", F.explode(each).alias("bucket")).select("fp", "node", "bucket.band", "bucket.key")
    rows = rows.withColumn("ones", F.bit_count("fp"))
    sizes = rows.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    small = rows.join(sizes.filter(F.col("size") <= tile).select("band", "key"), ["band", "key"])
    large = rows.join(sizes.filter(F.col("size") > tile), ["band", "key"])

    # Many small buckets go to a task in one run, sorted, so that no group costs a Python call of its own.
    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            whole = pa.Table.from_batches(held).combine_chunks()
            band, key = (whole.column(c).to_numpy() for c in ("band", "key"))
            cut = np.flatnonzero((band[1:] != band[:-1]) | (key[1:] != key[:-1])) + 1
            last = int(cut[-1]) if len(cut) else 0
            if last:
                yield forest(whole.slice(0, last), cut[:-1])
            held = whole.slice(last).to_batches()
        if held:
            yield forest(pa.Table.from_batches(held), np.zeros(0, np.int64))

    def forest(table: pa.Table, cut: np.ndarray) -> pa.RecordBatch:
        fp, node = (table.column(c).to_numpy() for c in ("fp", "node"))
        fp = fp.view(np.uint64)
        edges = np.concatenate([[0], cut, [len(fp)]])
        size = np.diff(edges)
        a_out, b_out = [], []
        two = edges[:-1][size == 2]
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= radius
        a_out.extend(node[two[near]].tolist())
        b_out.extend(node[two[near] + 1].tolist())
        for begin, n in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist(), strict=True):
            own, trees = node[begin: begin + n], _Forest(n)
            for a, b in _compare(fp[begin: begin + n], None, radius):
                if trees.join(a, b):
                    a_out.append(int(own[a]))
                    b_out.append(int(own[b]))
        return pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])

    near = (small.select("band", "key", "fp", "node").repartition("band", "key").sortWithinPartitions("band", "key")
            .mapInArrow(within, _EDGE))

    # Large buckets: tiles by bit count. Tiles hold one bit count each (split by hash beyond the tile size),
    # and a tile meets those whose bit count is at most the radius away.
    tiles = large.groupBy("band", "key", "ones").agg(F.count(F.lit(1)).alias("n")).select(
        "band", "key", "ones", F.ceil(F.col("n") / tile).cast("int").alias("parts"))
    other = tiles.select("band", "key", F.col("ones").alias("ones2"), F.col("parts").alias("parts2"))
    pair = (tiles.join(other, ["band", "key"]).filter((F.col("ones2") >= F.col("ones")) & (F.col("ones2") - F.col("ones") <= radius))
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("part2", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)))
            .filter((F.col("ones") < F.col("ones2")) | (F.col("part") <= F.col("part2"))))
    placed = large.join(tiles, ["band", "key", "ones"]).withColumn(
        "part", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int"))
    one = placed.join(pair, ["band", "key", "ones", "part"]).select(
        "band", "key", "ones", "part", "ones2", "part2", "fp", "node", F.lit(True).alias("first"))
    two = placed.select("band", "key", F.col("ones").alias("ones2"), F.col("part").alias("part2"), "fp", "node").join(
        pair, ["band", "key", "ones2", "part2"]).filter(
        (F.col("ones") < F.col("ones2")) | (F.col("part") < F.col("part2"))).select(
        "band", "key", "ones", "part", "ones2", "part2", "fp", "node", F.lit(False).alias("first"))

    def across(table: pa.Table) -> pa.Table:
        fp = table.column("fp").to_numpy().view(np.uint64)
        node = table.column("node").to_numpy()
        side = np.array(table.column("first").to_pylist(), dtype=bool)
        left, right = np.flatnonzero(side), np.flatnonzero(~side)
        trees, out = _Forest(len(fp)), []
        own = not len(right)
        for a, b in _compare(fp[left], None if own else fp[right], radius):
            x, y = int(left[a]), int(left[b] if own else right[b])
            if trees.join(x, y):
                out.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    far = one.unionByName(two).groupBy("band", "key", "ones", "part", "ones2", "part2").applyInArrow(across, _EDGE)
    return near.unionByName(far)


def groups(docs: DataFrame, shingle: int, radius: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, fp, component, component_id) per row; ``component`` is a fingerprint that names the group."""
    marked = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = stored(marked.groupBy("fp").agg(F.min(KEY_ID).alias("least")), "marks")
    found = components(links(distinct.select("fp", F.col("fp").alias("node")), radius))
    placed = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    heads = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    return marked.join(placed.join(heads, "component").select("fp", "component", "component_id"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of each row.

    component_id is the least id reachable over links, the row's own included.
    """
    return groups(docs, shingle, radius, id_col, text_col).select(
        F.col(KEY_ID).alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of least id (null ids last, ties by text hash), with all its columns."""
    found = stored(groups(docs, shingle, radius, id_col, text_col), "near")
    first = F.min(F.struct(F.col(KEY_ID).isNull(), KEY_ID, KEY_HASH)).alias("first")
    heads = found.groupBy("component").agg(first).select(f"first.{KEY_ID}", f"first.{KEY_HASH}")
    kept = attach(with_key(docs, id_col, text_col), heads, "left_semi")
    twins = found.groupBy(KEY_ID, KEY_HASH).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Texts are dealt out again only if rows repeat.
    return (kept if twins.isEmpty() else kept.dropDuplicates([KEY_ID, KEY_HASH])).drop(KEY_ID, KEY_HASH)
