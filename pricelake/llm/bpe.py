"""Byte-level BPE encoding and decoding with segment trees over byte positions.

A piece (one match of the split pattern) starts as single bytes. Leaf i of
its segment tree holds the rank of the pair that starts at live position i;
each inner node holds the leftmost least rank below it, so the root names the
next merge. A merge rewrites three leaves (the pair, the neighbour before it
and the position that died) and their paths to the root: logarithmic work per
merge, also for very long pieces. Many pieces are merged side by side as rows
of one numpy array.

Defined results: a null or empty text has no tokens; repeated rows repeat;
ids may be null. Ranks are token ids. Every single byte must have a rank.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import arrow_rows, pieces

#: Distinct pieces whose tokens a task remembers; then it starts afresh.
REMEMBERED = 200_000
#: Tree entries that are worked on at once.
TREE_ENTRIES = 1 << 18

_NONE = np.int64(1) << np.int64(62)
_SHIFT = np.int64(32)
_LOW = (np.int64(1) << _SHIFT) - np.int64(1)


class Vocabulary:
    """Ranks of byte strings and of the pairs that make them up."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a rank: {missing[:5]}")
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.token = {i: t for t, i in ranks.items()}
        left, right, whole = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    whole.append(rank)
        key = np.array(left, dtype=np.int64) << _SHIFT | np.array(right, dtype=np.int64)
        order = np.argsort(key)
        self.pair, self.merged = key[order], np.array(whole, dtype=np.int64)[order]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From lines of ``base64 rank``."""
        with open(path, "rb") as file:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())})

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; ``_NONE`` where the pair makes no token."""
        key = left << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.merged[at], _NONE) if len(self.pair) else np.full(len(key), _NONE)

    def merge_rows(self, rows: list[bytes], leaves: int) -> list[list[int]]:
        """Token ids of pieces of at most ``leaves`` (a power of two) bytes each."""
        n = len(rows)
        length = np.array([len(r) for r in rows], dtype=np.int64)
        # A row has one spare cell, the end mark: position ``leaves``.
        wide = leaves + 1
        token = np.zeros((n, wide), dtype=np.int64)
        inside = np.arange(wide) < length[:, None]
        token[inside] = self.single[np.frombuffer(b"".join(rows), dtype=np.uint8)]
        after = np.tile(np.arange(1, wide + 1, dtype=np.int64), (n, 1))
        after[after >= length[:, None]] = leaves
        before = np.tile(np.arange(-1, leaves, dtype=np.int64), (n, 1))
        before[:, 0] = leaves
        tree = np.full((n, 2 * leaves), _NONE, dtype=np.int64)
        pairs = inside[:, 1:]
        rank = self.pair_rank(token[:, :-1][pairs], token[:, 1:][pairs])
        where = np.broadcast_to(np.arange(leaves, dtype=np.int64), (n, leaves))[pairs]
        leaf = tree[:, leaves:]
        leaf[pairs] = np.where(rank < _NONE, rank << _SHIFT | where, _NONE)
        level = leaves
        while level > 1:
            level //= 2
            tree[:, level: 2 * level] = np.minimum(tree[:, 2 * level: 4 * level: 2], tree[:, 2 * level + 1: 4 * level: 2])
        token_, after_, before_, tree_ = (x.reshape(-1) for x in (token, after, before, tree))

        def update(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            base = row * (2 * leaves)
            node = at + leaves
            tree_[base + node] = value
            while len(node) and node[0] > 1:
                node = node >> 1
                tree_[base + node] = np.minimum(tree_[base + 2 * node], tree_[base + 2 * node + 1])

        def leaf_value(row: np.ndarray, at: np.ndarray) -> np.ndarray:
            cell = row * wide
            right = after_[cell + at]
            rank = self.pair_rank(token_[cell + at], token_[cell + np.minimum(right, leaves)])
            return np.where((right < leaves) & (rank < _NONE), rank << _SHIFT | at, _NONE)

        row = np.arange(n, dtype=np.int64)
        while True:
            root = tree_[row * (2 * leaves) + 1]
            live = root < _NONE
            if not live.any():
                break
            row, root = row[live], root[live]
            at, cell = root & _LOW, row * wide
            gone = after_[cell + at]
            far = after_[cell + gone]
            token_[cell + at] = root >> _SHIFT
            after_[cell + at] = far
            before_[cell + far] = at
            update(row, gone, np.full(len(row), _NONE))
            update(row, at, leaf_value(row, at))
            prior = before_[cell + at]
            has = prior < leaves
            update(row[has], prior[has], leaf_value(row[has], prior[has]))
            token_[cell + gone] = -1
        token[~inside] = -1
        alive = token[:, :leaves] >= 0
        flat, ends = token[:, :leaves][alive].tolist(), np.cumsum(alive.sum(1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode_pieces(self, parts: list[bytes]) -> list[list[int]]:
        """Token ids of each piece; a piece that is itself a token needs no merge."""
        out: list[list[int] | None] = [[r] if (r := self.ranks.get(p)) is not None else None for p in parts]
        classes: dict[int, list[int]] = {}
        for i, found in enumerate(out):
            if found is None:
                classes.setdefault(1 << max(1, (len(parts[i]) - 1).bit_length()), []).append(i)
        for leaves, members in classes.items():
            step = max(1, TREE_ENTRIES // leaves)
            for k in range(0, len(members), step):
                some = members[k: k + step]
                for i, ids in zip(some, self.merge_rows([parts[i] for i in some], leaves), strict=True):
                    out[i] = ids
        return out


def encode_text(text: str, vocabulary: Vocabulary, pattern: str) -> list[int]:
    """Token ids of one text (for small inputs and tests)."""
    parts = [p.encode() for p in regex.findall(pattern, text)]
    return [i for ids in vocabulary.encode_pieces(parts) for i in ids]


class _Remembered:
    """Distinct pieces met so far: (ids joined by commas, ids, decoded bytes)."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find, self.known = vocabulary, regex.compile(pattern).findall, {}

    def split(self, texts: list[str]) -> list[list[str]]:
        found = [self.find(t) for t in texts]
        new = set().union(*found) - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = set().union(*found)
        some = list(new)
        token = self.vocabulary.token
        for part, ids in zip(some, self.vocabulary.encode_pieces([s.encode() for s in some]), strict=True):
            self.known[part] = (",".join(map(str, ids)), ids, b"".join([token[i] for i in ids]))
        return found


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     ids: bool = True, digests: bool = False) -> DataFrame:
    """(id, n_tokens[, ids][, ids_sha256, decoded_sha256]) per row of ``docs``.

    ``ids`` adds the token ids as array<int>; ``digests`` the hex SHA-256 of
    the comma-joined decimal ids and of the bytes they decode to.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    sent = spark.sparkContext.broadcast(Vocabulary.load(ranks_path))
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [slim.schema["doc_id"], T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids
    fields += [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")] * digests
    names = [f.name for f in fields]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _Remembered(sent.value, pattern)
        for batch in pieces(batches, "text"):
            count, lists, id_hash, back = [], [], [], []
            for parts in memory.split([t or "" for t in batch.column(1).to_pylist()]):
                known = [memory.known[p] for p in parts]
                count.append(sum([len(k[1]) for k in known]))
                if ids:
                    lists.append([i for k in known for i in k[1]])
                if digests:
                    id_hash.append(hashlib.sha256(",".join([k[0] for k in known]).encode()).hexdigest())
                    back.append(hashlib.sha256(b"".join([k[2] for k in known])).hexdigest())
            columns = [batch.column(0), pa.array(count, pa.int64())]
            columns += [pa.array(lists, pa.list_(pa.int32()))] * ids
            columns += ([pa.array(id_hash, pa.string()), pa.array(back, pa.string())]) * digests
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return slim.mapInArrow(encode, T.StructType(fields)).withColumnRenamed("doc_id", id_col)


def decode_documents(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, bytes): the byte string that the token ids stand for; null ids decode to no bytes."""
    spark = encoded.sparkSession
    arrow_rows(spark)
    sent = spark.sparkContext.broadcast(Vocabulary.load(ranks_path))
    slim = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = sent.value.token
        for batch in batches:
            back = [b"".join([token[i] for i in row or ()]) for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(back, pa.binary())], names=["doc_id", "bytes"])

    schema = T.StructType([slim.schema["doc_id"], T.StructField("bytes", T.BinaryType())])
    return slim.mapInArrow(decode, schema).withColumnRenamed("doc_id", id_col)
