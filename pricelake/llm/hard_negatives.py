"""Hard negatives by Fagin's threshold algorithm.

Candidates are dealt into blocks of bounded size. A block keeps, for each
dimension, the list of its rows sorted by that component. For an anchor the
lists are read side by side from the end that its component's sign prefers;
each row met is scored at once by its exact integer inner product (random
access). No unmet row can score above the threshold, the sum of the anchor's
components times the values the lists have reached, so reading stops as soon
as the threshold lies strictly below the k-th score of every window that is
still sought (strictly, since a tie may go to a smaller id).

Anchors are dealt into slices; each slice meets each block once, for the
positives and again, once the best of all blocks are known, for the windows
below them. Neither labels nor equal vectors decide where a row goes.

Rows with a null label or vector, or with a null or non-finite component, take
no part. Shorter vectors count as if zeros followed. Rows of one id are rows of
their own; a null id sorts last among equal scores. An empty table gives no
rows. Scores must fit 64 bits a hundredfold, else the job fails.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import stored

#: Candidates of a block, anchors of a slice.
BLOCK, SLICE = 8192, 1024
#: Rows that the first step reads of each list; each further step reads as many as all before it.
FIRST_STEP = 64

BLOCKS = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("at", T.StringType()),
    T.StructField("x", T.BinaryType()), T.StructField("lists", T.BinaryType()), T.StructField("rows", T.BinaryType()),
    T.StructField("labels", T.BinaryType()), T.StructField("ids", T.ArrayType(T.LongType()))])
FOUND = T.StructType([T.StructField(c, T.LongType()) for c in ("anchor", "window", "row", "id", "score")])


class Block:
    """Candidates (one row each of ``x``, integers) with a sorted list of rows for each dimension."""

    def __init__(self, x: np.ndarray, lists: np.ndarray):
        self.x, self.lists = x, lists
        self.reached = np.take_along_axis(x.T, lists.astype(np.int64), axis=1)
        self.most = int(np.abs(x.astype(np.float64)).max(initial=0))
        self.inexact = x.astype(np.float64)

    @staticmethod
    def sorted_lists(x: np.ndarray) -> np.ndarray:
        small = np.uint16 if len(x) <= 1 << 16 else np.uint32
        return np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T.astype(small))

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products: in doubles where every sum fits their 53 bits, else in integers."""
        bound = self.most * int(max(abs(int(a)) for a in anchor)) * len(anchor) if len(anchor) else 0
        if bound < 1 << 53:
            return (self.inexact[rows] @ anchor.astype(np.float64)).astype(np.int64)
        if bound < 1 << 63:
            return self.x[rows].astype(np.int64) @ anchor.astype(np.int64)
        exact = [sum(int(a) * int(b) for a, b in zip(row, anchor, strict=True)) for row in self.x[rows]]
        if any(not -(1 << 63) <= s < 1 << 63 for s in exact):
            raise OverflowError("an inner product does not fit 64 bits")
        return np.array(exact, np.int64)

    def read(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Sorted access: (rows first met, their scores, threshold for rows not met yet), None when none is left."""
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        n = len(self.x)
        met = np.zeros(n, bool)
        depth, end = 0, min(n, FIRST_STEP)
        if not len(up) and not len(down):
            end = n
            met[:] = True
            yield np.arange(n), np.zeros(n, np.int64), None
            return
        while depth < n:
            now = np.zeros(n, bool)
            now[self.lists[up, n - end: n - depth]] = True
            now[self.lists[down, depth: end]] = True
            rows = np.flatnonzero(now & ~met)
            met |= now
            threshold = None
            if end < n:
                threshold = sum(int(anchor[d]) * int(self.reached[d, n - end]) for d in up)
                threshold += sum(int(anchor[d]) * int(self.reached[d, end - 1]) for d in down)
            yield rows, self.scores(rows, anchor), threshold
            depth, end = end, min(n, 2 * end)


class Best:
    """The k best (score, then smaller id, then smaller row) of the rows offered so far."""

    def __init__(self, k: int, ids: np.ndarray, rows: np.ndarray):
        self.k, self.ids, self.rows = k, ids, rows
        self.at, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, at: np.ndarray, score: np.ndarray) -> None:
        if len(self.at) == self.k and len(score):
            some = score >= self.score[-1]
            at, score = at[some], score[some]
        if len(score) > 4 * self.k:  # ties of the k-th stay for the order by id
            some = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            at, score = at[some], score[some]
        at, score = np.concatenate([self.at, at]), np.concatenate([self.score, score])
        order = np.lexsort((self.rows[at], self.ids[at], -score))[: self.k]
        self.at, self.score = at[order], score[order]

    def open_to(self, threshold: int) -> bool:
        """Whether an unmet row, scoring at most ``threshold``, might still come in."""
        return len(self.at) < self.k or threshold >= self.score[-1]


def best_positives(block: Block, anchor: np.ndarray, same: np.ndarray, best: Best) -> None:
    """Into ``best``: the best rows among ``same`` (a mask)."""
    if not same.any():
        return
    for rows, score, threshold in block.read(anchor):
        take = same[rows]
        best.offer(rows[take], score[take])
        if threshold is not None and not best.open_to(threshold):
            return


def best_in_windows(block: Block, anchor: np.ndarray, other: np.ndarray, windows: list[tuple[int, int]], best: list[Best]) -> None:
    """Into each ``best``: the best rows among ``other`` (a mask) whose 100-fold score lies within its window, bounds included."""
    sought = [w for w, (low, high) in enumerate(windows) if low <= high]
    if not other.any() or not sought:
        return
    least = min(-(-windows[w][0] // 100) for w in sought)
    most = max(windows[w][1] // 100 for w in sought)
    for rows, score, threshold in block.read(anchor):
        take = other[rows] & (score >= least) & (score <= most)
        rows, score = rows[take], score[take]
        for w in sought:
            low, high = windows[w]
            inside = (score >= -(-low // 100)) & (score <= high // 100)
            best[w].offer(rows[inside], score[inside])
        if threshold is not None:
            sought = [w for w in sought if 100 * threshold >= windows[w][0] and best[w].open_to(threshold)]
            if not sought:
                return


def _narrow(x: np.ndarray) -> np.ndarray:
    most = int(np.abs(x.astype(np.float64)).max(initial=0))
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy() if len(column) else np.zeros(0, np.int64)
    return flat.reshape(len(column), width)


def _ids(values: list[int | None]) -> np.ndarray:
    """Ids in order of ties: null last."""
    return np.array([np.iinfo(np.int64).max if v is None else v for v in values], np.int64)


def _opened(row: dict) -> tuple[Block, np.ndarray, np.ndarray, list[int | None]]:
    labels = np.frombuffer(row["labels"], np.int64)
    x = np.frombuffer(row["x"], row["kind"]).reshape(len(labels), -1)
    lists = np.frombuffer(row["lists"], row["at"]).reshape(x.shape[1], len(labels))
    return Block(x, lists), labels, np.frombuffer(row["rows"], np.int64), row["ids"]


def integer_vectors(vectors: DataFrame, is_anchor: Column, scale: int, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(row, id, label, chosen, q) of the rows that take part; q are the floors of the scaled components, all of one length."""
    v = F.col(vector_col)
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = vectors.filter(F.col(label_col).isNotNull() & v.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("chosen"),
        F.transform(v, lambda x: F.floor(x.cast("double") * float(scale)).cast("long")).alias("q"))
    kept = stored(rows, "vectors")
    width = kept.agg(F.max(F.size("q"))).first()[0] or 0
    return kept.withColumn("q", F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("q"))))


def sorted_blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """One row a block of candidates, with its sorted lists."""

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_pylist()
        x = _narrow(_matrix(table.column("q"), len(table.column("q")[0])))
        lists = Block.sorted_lists(x)
        line = {"block": key[0].as_py(), "kind": x.dtype.str, "at": lists.dtype.str, "x": x.tobytes(), "lists": lists.tobytes(),
                "rows": table.column("row").to_numpy().tobytes(), "labels": table.column("label").to_numpy().tobytes(), "ids": ids}
        types = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.Table.from_arrays([pa.array([line[n]], t) for n, t in zip(BLOCKS.fieldNames(), types, strict=True)], names=BLOCKS.fieldNames())

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    return stored(dealt.groupBy("block").applyInArrow(build, BLOCKS), "blocks")


def _search(anchors: DataFrame, lists: DataFrame, blocks: int, slices: int, k: int, windows: bool) -> DataFrame:
    """FOUND rows: each block's best for each anchor (and window)."""

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            block, labels, rows, ids = _opened(right.slice(0, 1).to_pylist()[0])
            order = _ids(ids)
            vectors = _matrix(left.column("q"), block.x.shape[1])
            spans = left.column("windows").to_pylist() if windows else None
            for i, (row, label) in enumerate(zip(left.column("row").to_pylist(), left.column("label").to_pylist(), strict=True)):
                if windows:
                    best = [Best(k, order, rows) for _ in spans[i]]
                    best_in_windows(block, vectors[i], labels != label, [(w["low"], w["high"]) for w in spans[i]], best)
                    names = [w["window"] for w in spans[i]]
                else:
                    best, names = [Best(k, order, rows)], [0]
                    best_positives(block, vectors[i], (labels == label) & (rows != row), best[0])
                out += [(row, name, int(rows[at]), ids[at], int(score)) for name, b in zip(names, best, strict=True)
                        for at, score in zip(b.at.tolist(), b.score.tolist(), strict=True)]
        columns = zip(*out, strict=True) if out else [[]] * len(FOUND)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=FOUND.fieldNames())

    met = anchors.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices))).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    sent = lists.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))))
    found = met.groupBy("block", "slice").cogroup(sent.groupBy("block", "slice")).applyInArrow(search, FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100,
                   scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows for which ``is_anchor`` (a condition on their columns) holds. An anchor's
    positives are its ``positives`` best other rows of its label; for each, the
    ``negatives`` best rows of other labels that score between ``low`` and
    ``high`` percent of it. Vectors become integers, floor(``scale`` * x); a
    score is the inner product. Labels and ids must be integers.
    """
    rows = integer_vectors(vectors, is_anchor, scale, id_col, vector_col, label_col)
    anchors = rows.filter("chosen").select("row", "id", "label", "q")
    count = rows.agg(F.count("*").alias("rows")).first()[0]
    slices = max(1, -(-anchors.count() // SLICE))
    blocks = max(1, -(-count // BLOCK))
    lists = sorted_blocks(rows, blocks)
    near = stored(_search(anchors, lists, blocks, slices, positives, windows=False), "positives").select(
        "anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    spans = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "window", (F.lit(low) * F.col("positive_score")).alias("low"), (F.lit(high) * F.col("positive_score")).alias("high")))).alias("windows"))
    asked = anchors.join(spans, anchors["row"] == spans["anchor"]).drop("anchor")
    found = _search(asked, lists, blocks, slices, negatives, windows=True).select(
        "anchor", "window", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (found.join(near, ["anchor", "window"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
