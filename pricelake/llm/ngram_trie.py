"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Counts come from all training documents, and every n-gram counted is in the
model: all words, bigrams and trigrams, down to those seen once. The model
grows with the corpus, so it lies in shards. A trigram (a, b, c) belongs
to the shard of its middle word b, which holds all that a token c after a, b
needs: the trigrams around b, the bigrams that begin with b and the counts of their last words.
A word of many tokens has several shards, by a hash of a; its bigrams are added up on their own, and each of its shards reads those it is asked for.

Texts are split into tokens once. About a million tokens make a block, a file in the shared checkpoint folder with its words and, packed,
their numbers in it; whatever comes later reads blocks. A block sends each distinct trigram once, with its training count and the counts
of its rare words, packed, to its shard, whose task builds the levels from all blocks' counts, looks each distinct trigram up and
gives each block its answers, as whole quantisation units, in the block's order. The block adds them up by text.
Neither the driver nor a broadcast holds a level.

In a shard words are numbered by their place among its word keys (numbers of the words sent to every task, 63-bit hashes of rare ones).
Level 1 is the words. In level 2 the pairs (context, word) are one
monotone sequence, in level 3 a word is numbered relative to its context: by
its place among the successors of the word before it. Sequences and pointers
are Elias-Fano coded (low bits packed, high bits in unary), smoothed probabilities and
back-off weights are quantised to 16 bits. A successor is found by its high bits, then by halves among its low bits.

Smoothing is interpolated absolute discounting over the base model
(c + 0.5) / (N + 0.5 (V + 1)), so every word, also an unknown one, has a probability.
The score is the base score plus what each token's context changes. The words with a share of
``share`` or more of all tokens (at most 1/share) are broadcast with their counts; a block gets those of its other
words from the whole count table. The share changes no result.

Defined results: a null or empty text is one end token; repeated rows count as
documents of their own and repeat; a row whose id is null is scored, and its fold is the caller's.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import arrow_rows, pieces, stored
from pricelake.llm.files import open_store
from pricelake.session import scratch_dir

#: The end token; no word contains a line feed.
END = b"\n"
#: Least share of the training tokens of a word whose count is broadcast.
SHARE = 1e-6
#: Count subtracted from each n-gram.
DISCOUNT = 0.75
#: Steps of log10 probability per quantisation unit.
STEPS = 4096
#: Tokens of a block; words a task counts before it hands them on are a quarter.
FLUSH = 1_000_000
#: Tokens of a shard.
SHARD_TOKENS = 1_000_000
#: Numbers that are worked on at once where arrays are long.
CHUNK = 1 << 16


class EliasFano:
    """Monotone integers: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        # The unary part as a directory: start[h] is the first element with high bits h or more.
        bits = np.unpackbits(np.asarray(high), bitorder="little")
        zeros = np.flatnonzero(bits == 0)
        self.start = np.concatenate([[0], zeros - np.arange(len(zeros))]).astype(np.int64)
        self.start = np.minimum(self.start, n)
        low = np.ascontiguousarray(low)
        self.wide = np.ndarray(max(0, len(low) - 7), "<i8", low, strides=(1,))

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        return cls(*cls.parts(values))

    @staticmethod
    def parts(values: np.ndarray) -> tuple[int, int, np.ndarray, np.ndarray]:
        """(n, low bits, packed low parts, unary high parts) of non-decreasing numbers."""
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (top // max(1, n)).bit_length() - 1)
        low = EliasFano._low(values, low_bits)
        high = np.zeros(n + (top >> low_bits) + 2, dtype=np.uint8)
        high[(values >> low_bits) + np.arange(n)] = 1
        return n, low_bits, np.concatenate([low, np.zeros(9, np.uint8)]), np.packbits(high, bitorder="little")

    @staticmethod
    def _low(values: np.ndarray, low_bits: int) -> np.ndarray:
        out = [np.zeros(0, np.uint8)]
        for at in range(0, len(values) if low_bits else 0, CHUNK):  # a chunk of so many numbers fills whole bytes
            octets = np.ascontiguousarray(values[at: at + CHUNK], "<i8").view(np.uint8).reshape(-1, 8)
            out.append(np.packbits(np.unpackbits(octets, axis=1, count=low_bits, bitorder="little"), bitorder="little"))
        return np.concatenate(out)

    def low_part(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.low_bits
        byte, shift = bit >> 3, bit & 7
        if self.low_bits <= 56:  # within the eight bytes from there on
            return (self.wide[byte] >> shift) & ((1 << self.low_bits) - 1)
        out = np.zeros(len(at), dtype=np.int64)
        for k in range((self.low_bits + 7 + 7) // 8):
            out |= self.low[byte + k].astype(np.int64) << (8 * k)
        return (out >> shift) & ((1 << self.low_bits) - 1)

    def find(self, targets: np.ndarray) -> np.ndarray:
        """Index of each target, -1 where it is not in the sequence (negative targets never are)."""
        out = np.full(len(targets), -1, dtype=np.int64)
        high = targets >> self.low_bits
        some = np.flatnonzero((targets >= 0) & (high + 1 < len(self.start)))
        at, end = self.start[high[some]], self.start[high[some] + 1]
        low = targets[some] & ((1 << self.low_bits) - 1)
        stop = end.copy()
        live = np.flatnonzero(at < end)
        while len(live):  # by halves: a frequent context has very many successors with the same high bits
            mid = (at[live] + end[live]) >> 1
            less = self.low_part(mid) < low[live]
            at[live[less]] = mid[less] + 1
            end[live[~less]] = mid[~less]
            live = live[at[live] < end[live]]
        some, at, low = (x[at < stop] for x in (some, at, low))
        hit = self.low_part(at) == low
        out[some[hit]] = at[hit]
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at these indices."""
        high = np.searchsorted(self.start, at, side="right") - 1
        return high << self.low_bits | self.low_part(at)

    def every(self) -> np.ndarray:
        """All the numbers."""
        high = np.repeat(np.arange(len(self.start)), np.diff(np.append(self.start, self.n)))
        return high << self.low_bits | self.low_part(np.arange(self.n))


def quantised(log10: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-log10 * STEPS), 0, 65535).astype(np.uint16)


class Trie:
    """The mapped levels: ``score`` gives the part of a text's log10 probability that needs no rare word's count."""

    def __init__(self, file: str):
        levels = _mapped(file)
        self.keys = levels.get("keys")
        self.words, self.unigram = int(levels["words"][0]), levels["unigram"]
        self.pairs, self.pointers, self.triples = (
            EliasFano(*map(int, levels[f"{k}_size"]), levels[f"{k}_low"], levels[f"{k}_high"]) for k in ("pairs", "pointers", "triples"))
        self.begin = self.pointers.every()
        self.width = int(levels["width"][0])
        self.log = {k: levels[k] for k in ("pair_log", "pair_back", "word_back", "triple_log")}

    def score(self, word: np.ndarray, before: np.ndarray, head: np.ndarray) -> np.ndarray:
        """log10 probability of each token; rare words (-1) lack their base part.

        ``before`` is the token before (the end token at a text's head), ``head`` marks first tokens.
        """
        pair = self.pair(before, word)
        prior = np.concatenate([[-1], pair[:-1]])
        prior[head] = -1
        units, plain = self.units(word, before, pair, prior)
        out = units / -STEPS
        out[plain] += self.unigram[word[plain]]
        return out

    def pair(self, before: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of the bigrams, -1 where there is none."""
        return self.pairs.find(np.where((word >= 0) & (before >= 0), before * self.words + word, -1))

    def units(self, word: np.ndarray, before: np.ndarray, pair: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(quantisation units of -log10, whether the word's base probability comes on top) of each token.

        ``pair`` is the place of (before, word), ``prior`` that of the bigram before it.
        """
        triple = np.full(len(word), -1, dtype=np.int64)
        both = np.flatnonzero((pair >= 0) & (prior >= 0))
        if len(both):
            relative = pair[both] - self.begin[before[both]]
            triple[both] = self.triples.find(prior[both] * self.width + relative)
        out = np.zeros(len(word), dtype=np.int64)
        has = triple >= 0
        out[has] = self.log["triple_log"][triple[has]]
        rest = ~has
        back = rest & (prior >= 0)
        out[back] += self.log["pair_back"][prior[back]]
        two = rest & (pair >= 0)
        out[two] += self.log["pair_log"][pair[two]]
        one = rest & (pair < 0)
        known = one & (before >= 0)
        out[known] += self.log["word_back"][before[known]]
        return out, one & (word >= 0)


def _mapped(file: str) -> dict[str, np.ndarray]:
    """Arrays of a level file, mapped read-only."""
    whole = np.memmap(file, dtype=np.uint8, mode="r")
    out, at = {}, 0
    while at < len(whole):
        size = int(whole[at: at + 8].view(np.int64)[0])
        name, kind, count = bytes(whole[at + 8: at + 8 + size]).decode().split(" ")
        at += 8 + size
        at += -at % 8
        length = int(count) * np.dtype(kind).itemsize
        out[name] = whole[at: at + length].view(kind)
        at += length + -length % 8
    return out


def level_file(arrays: dict[str, np.ndarray]) -> bytes:
    """The levels as one file: for each array a short header, then its bytes, at multiples of eight."""
    out = io.BytesIO()
    for name, array in arrays.items():
        head = f"{name} {array.dtype.str} {len(array)}".encode()
        out.write(len(head).to_bytes(8, "little") + head)
        out.write(b"\0" * (-out.tell() % 8))
        out.write(array.tobytes())
        out.write(b"\0" * (-out.tell() % 8))
    return out.getvalue()


def open_trie(levels: bytes) -> Trie:
    """Map the levels from a temporary file, whose name is removed at once."""
    handle, file = tempfile.mkstemp(prefix="trie-")
    try:
        with os.fdopen(handle, "wb") as out:
            out.write(levels)
        return Trie(file)
    finally:
        os.unlink(file)


def build_levels(counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, triples: np.ndarray, triple_counts: np.ndarray,
                 total: int, distinct: int, discount: float = DISCOUNT, successors: np.ndarray | None = None) -> bytes:
    """The level file. ``pairs`` are (context * words + word), ``triples`` (pair index * words + word), both sorted.

    ``successors`` is not 0 for words with only some of their bigrams here: the number of all.
    """
    words = len(counts)
    plain = (counts + 0.5) / (total + 0.5 * (distinct + 1))
    unigram = np.log10(plain)
    context, word = pairs // max(1, words), pairs % max(1, words)
    share = (pair_counts - discount) / counts[context]
    rest = 1 - np.bincount(context, share, minlength=words)
    if successors is not None:
        some = np.flatnonzero(successors)
        rest[some] = discount * successors[some] / counts[some]
    rest = np.clip(rest, 1e-6, 1)
    smooth = share + rest[context] * plain[word]
    pointers = np.searchsorted(context, np.arange(words + 1))
    parent, last = triples // max(1, words), triples % max(1, words)
    lower = np.searchsorted(pairs, word[parent] * words + last)
    relative = lower - pointers[word[parent]]
    width = int((pointers[1:] - pointers[:-1]).max(initial=0)) + 1
    share3 = (triple_counts - discount) / pair_counts[parent]
    rest3 = np.clip(1 - np.bincount(parent, share3, minlength=len(pairs)), 1e-6, 1)
    smooth3 = share3 + rest3[parent] * smooth[lower]
    out = {"words": np.array([words]), "width": np.array([width]), "unigram": unigram,
           "word_back": quantised(np.log10(rest)), "pair_log": quantised(np.log10(smooth)),
           "pair_back": quantised(np.log10(rest3)), "triple_log": quantised(np.log10(smooth3))}
    for name, values in (("pairs", pairs), ("pointers", pointers), ("triples", parent * width + relative)):
        n, low_bits, low, high = EliasFano.parts(values.astype(np.int64))
        out |= {f"{name}_size": np.array([n, low_bits]), f"{name}_low": low, f"{name}_high": high}
    return level_file(out)


def tokens(text: str | None) -> list[bytes]:
    """Words of the text, A-Z lower-cased, without the end token."""
    return (text or "").encode().lower().split()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the texts' words in order, A-Z lower-cased, number of words of each text)."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, size = found.flatten(), found.value_lengths().to_numpy()
    some = pc.not_equal(pc.binary_length(words), 0)  # blanks at a text's ends give empty ones
    owner = np.repeat(np.arange(len(size)), size)[some.to_numpy(zero_copy_only=False)]
    return words.filter(some), np.bincount(owner, minlength=len(size))


def _zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


class _Texts:
    """Tokens of some texts."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.docs: list[pa.RecordBatch] = []
        self.size = 0

    def add(self, keys: pa.Array, texts: pa.Array, learn: pa.Array) -> None:
        words, size = words_of(texts)
        self.words.append(words)
        self.docs.append(pa.RecordBatch.from_arrays([keys, learn, pa.array(size + 1)], names=["doc_id", "learn", "size"]))
        self.size += len(words) + len(size)

    def file(self) -> bytes:
        """The block's file: rows, words, how often each occurs in learned texts and in all, tokens.

        Words have numbers: 0 is the end token, then the most frequent come first.
        """
        docs, words = pa.Table.from_batches(self.docs), pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        size = docs.column("size").to_numpy()
        inner = np.ones(self.size, bool)
        inner[np.cumsum(size) - 1] = False
        local, kinds = words.indices.to_numpy(), words.dictionary.cast(pa.binary())
        order = np.argsort(-np.bincount(local, minlength=len(kinds)), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(1, len(order) + 1)
        c = np.zeros(self.size, np.int64)
        c[inner] = place[local]
        learned, n = (np.bincount(x, minlength=len(order) + 1) for x in (c[_each(docs)[0]], c))
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(docs)
        none = np.zeros(0, np.int64)
        parts = [sink.getvalue(), _zipped(b" ".join([END, *kinds.take(pa.array(order)).to_pylist()])), packed(none, [], [learned, n]), packed(none, [], [c])]
        return b"".join([len(x).to_bytes(8, "little") + x for x in parts])


def _each(docs: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(whether learned, row's place) of each token of a block's rows."""
    size = docs.column("size").to_numpy()
    return np.repeat(docs.column("learn").to_numpy(), size), np.repeat(np.arange(len(size)), size)


class _Block:
    """A block read back; ``counts`` and ``keys`` of its words are there once ``with_counts`` has written them."""

    def __init__(self, path: str, name: int, counts: bool = False):
        files, top = open_store(path)
        with files.open_input_file(f"{top}/{name}") as source:
            raw = source.read()
        parts, at = [], 0
        while at < len(raw):
            size = int.from_bytes(raw[at: at + 8], "little")
            parts.append(raw[at + 8: at + 8 + size])
            at += 8 + size
        self.docs = pa.ipc.open_stream(parts[0]).read_all()
        self.words = pc.split_pattern(pa.array([_unzipped(parts[1])], pa.large_binary()), pattern=b" ").flatten()
        self.learned, self.n = unpacked(parts[2])[1]
        self._tokens = parts[3]
        if counts:
            with files.open_input_file(f"{top}/{name}-counts") as source:
                self.counts, keys = unpacked(source.read())[1]
            self.keys = np.where(keys & 1, ~(keys >> 1), keys >> 1)

    def numbers(self, vocabulary: pa.Array) -> np.ndarray:
        """Places of the words in the numbering of all tasks: 0 is the end token, the words sent to every task follow, -1 is a rare one."""
        out = pc.fill_null(pc.index_in(self.words, value_set=vocabulary), -2).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        out[0] = 0
        return out

    def contexts(self) -> tuple[np.ndarray, ...]:
        """(keys in order, places of the words in them, middle word b, first word a, last word c) of each token c, as places in the keys; at a head b and a are the end token."""
        keys = self.keys
        order = np.argsort(keys)
        place = np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        c = place[unpacked(self._tokens)[1][0]]
        size = self.docs.column("size").to_numpy()
        start = np.cumsum(size) - size
        b = np.concatenate([place[:1], c[:-1]])
        a = np.concatenate([place[:1], b[:-1]])
        b[start], a[start] = place[0], place[0]
        return keys[order], place, b, a, c


def text_blocks(rows: DataFrame, path: str) -> DataFrame:
    """(block, tokens) of the files in the shared folder ``path`` that hold the ``rows`` (doc_id, text, learn)."""
    store, folder = open_store(path)
    store.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = open_store(path)

        def flushed(held: _Texts) -> pa.RecordBatch:
            name = uuid.uuid4().int >> 65  # of this attempt alone
            with files.open_output_stream(f"{top}/{name}") as out:
                out.write(held.file())
            return pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([held.size], pa.int64())], names=["block", "tokens"])

        held = _Texts()
        for batch in pieces(batches, "text"):
            held.add(*batch.columns)
            if held.size > FLUSH:
                yield flushed(held)
                held = _Texts()
        if held.size:
            yield flushed(held)

    return stored(rows.mapInArrow(write, "block long, tokens long"), "lm-blocks")


def word_counts(blocks: DataFrame, path: str) -> DataFrame:
    """(word, n, uses) of the blocks, the end token included: how often in learned texts, and in all; tasks add up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = _Block(path, name)
                held.append(pa.table({"word": block.words, "n": block.learned, "uses": block.n}))
                size += len(block.n)
                if size > FLUSH:
                    yield _summed(held)
                    held, size = [], 0
        if held:
            yield _summed(held)

    return blocks.mapInArrow(count, "word binary, n long, uses long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _summed(held: list[pa.Table]) -> pa.RecordBatch:
    whole = pa.concat_tables(held).combine_chunks()
    words = whole.column("word").combine_chunks().dictionary_encode()
    sums = [pa.array(np.bincount(words.indices.to_numpy(), whole.column(x).to_numpy()).astype(np.int64)) for x in ("n", "uses")]  # exact below 2 ** 53
    return pa.RecordBatch.from_arrays([words.dictionary.cast(pa.binary()), *sums], names=["word", "n", "uses"])


def with_counts(blocks: DataFrame, rare_words: DataFrame, number, counts, path: str) -> DataFrame:
    """(block) once a file beside each block holds the counts and keys of its words: those sent to every task, and the others from ``rare_words`` (word, n, id)."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = _Block(path, name)
                rare = np.flatnonzero(block.numbers(number.value) < 0)
                words = block.words.take(pa.array(rare)).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rare), name), pa.int64()), pa.array(rare, pa.int32()), words],
                                                 names=["block", "place", "word"])

    def write(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        name = key[0].as_py()
        keys = _Block(path, name).numbers(number.value)
        n = np.where(keys < 0, 0, counts.value[keys])
        place, sums, ids = (found.column(x).to_numpy() for x in ("place", "n", "id"))
        real = place >= 0
        n[place[real]], keys[place[real]] = sums[real], ~ids[real]
        files, top = open_store(path)
        with files.open_output_stream(f"{top}/{name}-counts") as out:  # an attempt writes the same bytes
            out.write(packed(np.zeros(0, np.int64), [], [n, np.where(keys < 0, ~keys << 1 | 1, keys << 1)]))
        return pa.table({"block": pa.array([name], pa.int64())})

    some = blocks.mapInArrow(ask, "block long, place int, word binary").join(rare_words.hint("merge"), "word").select("block", "place", "n", "id")
    every = blocks.select("block", F.lit(-1).alias("place"), *[F.lit(0).cast("long").alias(x) for x in ("n", "id")])  # also blocks without rare words
    return stored(some.unionByName(every).groupBy("block").applyInArrow(write, "block long"), "lm-counted")


def distinct_of(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([np.ones(min(1, len(x)), bool), x[1:] != x[:-1]])]


def added_up(columns: list[np.ndarray], top: int, n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows, in order, of equally long columns of numbers below ``top``, and the sum of ``n`` of each (default: how often it occurs)."""
    if top ** len(columns) < 1 << 63:  # as one number
        code = columns[0]
        for x in columns[1:]:
            code = code * top + x
        order = None if n is None else np.argsort(code)
        code = np.sort(code) if n is None else code[order]
        new = np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]])
        rest, out = code[new], []
        for _ in columns:
            rest, x = np.divmod(rest, top)
            out.append(x)
        out = out[::-1]
    else:
        order = np.lexsort(columns[::-1])
        columns = [x[order] for x in columns]
        new = np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in columns])])
        out = [x[new] for x in columns]
    at = np.flatnonzero(new)
    sums = np.diff(np.append(at, len(new))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return out, sums


def rare_used(keys: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Places of the rare words among ``words``, in order."""
    seldom = np.searchsorted(keys, 0)
    return distinct_of(np.concatenate([np.zeros(0, np.int64), *(x[x < seldom] for x in words)]))


def _planes(x: np.ndarray, width: int) -> bytes:
    """Numbers without a sign byte by byte: high bytes are nearly all alike."""
    return b"".join([(x >> 8 * k).astype(np.uint8).tobytes() for k in range(width)])


def _from_planes(data: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    for k in range(width):
        out |= data[k * n: (k + 1) * n].astype(np.int64) << 8 * k
    return out


def packed(keys: np.ndarray, words: list[np.ndarray], numbers: list[np.ndarray]) -> bytes:
    """Equally long columns as bytes: ``words`` are places in ``keys`` (in order), ``numbers`` have no sign; the first column of each is best in order.

    Rare words are written once; a word is its place among them, or its number after them.
    """
    rare, seldom, codes = rare_used(keys, words), np.searchsorted(keys, 0), []
    place = np.empty(seldom, np.int64)
    place[rare] = np.arange(len(rare))
    for x in words:
        code, some = keys[x] + len(rare), np.flatnonzero(x < seldom)
        code[some] = place[x[some]]
        codes.append(code)
    seldom = keys[rare]
    head, body = [len(numbers[0]), len(rare), len(words), len(numbers)], []
    if len(rare):
        step = np.diff(seldom, prepend=seldom[:1])
        width = max(1, (int(step.max()).bit_length() + 7) // 8)
        head += [int(seldom[0]), width]
        body.append(_planes(step, width))
    for x in [*codes, *numbers]:
        step = np.diff(x, prepend=x[:1])
        least, down = (int(x[0]), True) if len(x) and (step >= 0).all() else (0, False)
        x = step if down else x
        width = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
        head += [int(down), least, width]
        body.append(_planes(x, width))
    return _zipped(b"".join([np.array(head, "<i8").tobytes(), *body]))


def unpacked(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(columns of word keys, columns of numbers) of ``packed``."""
    whole = np.frombuffer(_unzipped(data), np.uint8)
    n, rare, words, numbers = whole[:32].view("<i8").tolist()
    at = 48 if rare else 32
    heads = whole[at: at + 24 * (words + numbers)].view("<i8").reshape(-1, 3).tolist()
    keys, at = np.zeros(rare, np.int64), at + 24 * (words + numbers)
    if rare:
        begin, width = whole[32: 48].view("<i8").tolist()
        keys = begin + np.cumsum(_from_planes(whole[at: at + rare * width], rare, width))
        at += rare * width
    out = []
    for down, least, width in heads:
        x = _from_planes(whole[at: at + n * width], n, width)
        at += n * width
        out.append(np.cumsum(x) + least if down else x)
    for k, code in enumerate(out[:words]):
        key = code - rare
        seldom = key < 0
        key[seldom] = keys[code[seldom]]
        out[k] = key
    return out[:words], out[words:]


def ranked(columns: list[np.ndarray], top: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(distinct rows, in order, of equally long columns of numbers below ``top``; the place of each row among them)."""
    code, limit = columns[0], top
    for x in columns[1:]:
        if limit > (1 << 63) // max(1, top):
            code = np.unique(code, return_inverse=True)[1]
            limit = len(code)
        code, limit = code * top + x, limit * top
    order, place = np.argsort(code), np.empty(len(code), np.int64)
    code = code[order]
    new = np.concatenate([np.ones(min(1, len(code)), bool), code[1:] != code[:-1]])
    place[order] = np.cumsum(new) - 1
    some = order[new]
    return [x[some] for x in columns], place


def _hash(x: np.ndarray) -> np.ndarray:
    """64-bit mix of whole numbers (splitmix)."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shard(keys: np.ndarray, b: np.ndarray, a: np.ndarray, splits: dict[int, int], shards: int) -> np.ndarray:
    """Shard of each (b, a), places in ``keys``: by b, and by a too for the words with ``splits``."""
    mixed, many = _hash(keys), np.ones(len(keys), np.uint64)
    split = np.array(sorted(splits), np.int64)
    at = np.minimum(np.searchsorted(keys, split), len(keys) - 1)
    many[at[keys[at] == split]] = np.array([splits[k] for k in split[keys[at] == split].tolist()], np.uint64)
    out = (_hash(mixed) % np.uint64(shards)).astype(np.int64)[b]
    salted = np.flatnonzero((many > 1)[b])
    out[salted] = (_hash(mixed[b[salted]] + mixed[a[salted]] % many[b[salted]]) % np.uint64(shards)).astype(np.int64)
    return out


def _by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(shard.astype(np.int16) if len(shard) and shard.max() < 1 << 15 else shard, kind="stable")
    found = shard[order]
    begin = np.flatnonzero(np.concatenate([np.ones(min(1, len(found)), bool), found[1:] != found[:-1]]))
    for one, rows in zip(found[begin].tolist(), np.split(order, begin[1:]), strict=len(order) > 0):
        yield one, rows


class _Dense:
    """Places of some word keys in their order: numbered words by a table, rare ones by search."""

    def __init__(self, known: int, columns: list[np.ndarray]):
        some = np.zeros(known, bool)
        for x in columns:
            some[x[x >= 0]] = True
        rare = distinct_of(np.concatenate([distinct_of(x[x < 0]) for x in columns]))
        self.rare, top = rare, np.flatnonzero(some)
        self.place = np.full(known, -1, np.int64)
        self.place[top] = len(rare) + np.arange(len(top))
        self.words = np.concatenate([rare, top])

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where they are not among them."""
        out = self.place[np.maximum(keys, 0)]
        seldom = np.flatnonzero(keys < 0)
        if len(seldom):
            at = np.minimum(np.searchsorted(self.rare, keys[seldom]), max(0, len(self.rare) - 1))
            out[seldom] = np.where(self.rare[at] == keys[seldom], at, -1) if len(self.rare) else -1
        return out


def split_pairs(blocks: DataFrame, splits: dict[int, int], known: int, path: str) -> dict[int, tuple[int, list[str]]]:
    """Of each word b with ``splits``: the number of its bigrams (b, c) in learned texts, and the files with their last words c and counts."""
    split = np.array(sorted(splits), np.int64)
    buckets = {b: -(-n // 16) for b, n in splits.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = _Block(path, name, counts=True)
                keys, _, b, _, c = block.contexts()
                some = np.flatnonzero(_each(block.docs)[0] & np.isin(keys, split)[b])
                (b, c), n = added_up([b[some], c[some]], len(keys))
                mixed = _hash(keys)[c]
                rows = []
                for one, at in _by_shard(b):
                    word = int(keys[one])
                    for bucket, part in _by_shard((mixed[at] % np.uint64(buckets[word])).astype(np.int64)):
                        rows.append((word, bucket, packed(keys, [c[at[part]]], [n[at[part]]])))
                words, places, pairs = zip(*rows, strict=True) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(places, pa.int64()), pa.array(pairs, pa.binary())],
                                                 names=["b", "bucket", "pairs"])

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        parts = [unpacked(x.as_py()) for x in rows.column("pairs")]
        c, n = np.concatenate([words[0] for words, _ in parts]), np.concatenate([numbers[0] for _, numbers in parts])
        dense = _Dense(known, [c])
        (c,), n = added_up([dense.of(c)], len(dense.words), n)
        files, top = open_store(path)
        name = f"pairs-{uuid.uuid4().hex}"  # of this attempt alone
        with files.open_output_stream(f"{top}/{name}") as out:
            out.write(packed(dense.words, [c], [n]))
        return pa.table({"b": pa.array([key[0].as_py()], pa.int64()), "file": [name], "kinds": pa.array([len(c)], pa.int64())})

    if not splits:
        return {}
    merged = stored(blocks.mapInArrow(count, "b long, bucket long, pairs binary").groupBy("b", "bucket").applyInArrow(
        merge, "b long, file string, kinds long"), "lm-pairs")
    return {r["b"]: (r["kinds"], r["files"]) for r in merged.groupBy("b").agg(F.sum("kinds").alias("kinds"), F.collect_list("file").alias("files")).collect()}


class _Asked:
    """The distinct trigrams of a block, dealt to shards."""

    def __init__(self, block: _Block, splits: dict[int, int], shards: int):
        keys, place, *columns = block.contexts()
        self.keys, self.counts = keys, np.empty(len(keys), np.int64)
        self.counts[place] = block.counts
        self.last = columns[2]  # of each token
        self.columns, self.place = ranked(columns, len(keys))
        self.n = np.bincount(self.place[_each(block.docs)[0]], minlength=len(self.columns[0]))
        self.shards = list(_by_shard(_shard(keys, self.columns[0], self.columns[1], splits, shards)))

    def rows(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(shard, trigrams (b, a, c) with their training counts, counts of their rare words)."""
        for shard, at in self.shards:
            words = [x[at] for x in self.columns]
            yield shard, packed(self.keys, words, [self.n[at]]), packed(self.keys, [], [self.counts[rare_used(self.keys, words)]])


def asked_blocks(blocks: DataFrame, splits: dict[int, int], shards: int, path: str) -> DataFrame:
    """(shard, block, grams, rare) of every block and each shard it has trigrams of."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                ids, grams, rare = zip(*_Asked(_Block(path, name, counts=True), splits, shards).rows(), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.full(len(ids), name), pa.int64()), pa.array(grams, pa.binary()),
                                                  pa.array(rare, pa.binary())], names=["shard", "block", "grams", "rare"])

    return blocks.mapInArrow(ask, "shard long, block long, grams binary, rare binary")


def build_shard(grams: list[np.ndarray], many: np.ndarray, end: int, shared: dict[int, tuple[int, np.ndarray, np.ndarray]], total: int, distinct: int) -> Trie:
    """The levels of one shard, of its trigrams (b, a, c, n), as places among its words, and the words' counts ``many``; the end token is at ``end``.

    ``shared`` has, for the words with several shards, the number of all their bigrams, the last words of those here and their counts.
    """
    b, a, c, n = grams
    size = len(many)
    successors = np.zeros(size, np.int64)
    for word, (kinds, _, _) in shared.items():
        successors[word] = kinds
    own = successors[b] == 0
    (begin, last), pair_n = added_up([b[own], c[own]], size, n[own])
    for word, (_, after, after_n) in shared.items():
        begin, last, pair_n = np.concatenate([begin, np.full(len(after), word)]), np.concatenate([last, after]), np.concatenate([pair_n, after_n])
    inner = b != end  # a head has no trigram
    b, a, c, n = b[inner], a[inner], c[inner], n[inner]
    # A word before the middle one: its pair's count is the sum of its trigrams, as only the end token has none after it.
    (front, middle), front_n = added_up([a, b], size, n)
    both, first = np.unique(np.concatenate([begin * size + last, front * size + middle]), return_index=True)
    both_n = np.concatenate([pair_n, front_n])[first]
    triple = np.searchsorted(both, a * size + b) * size + c
    order = np.argsort(triple)
    return open_trie(build_levels(many, both, both_n, triple[order], n[order], total, distinct, successors=successors))


def shard_units(trie: Trie, b: np.ndarray, a: np.ndarray, c: np.ndarray, end: int) -> np.ndarray:
    """Twice the quantisation units of each token c after a, b, and one more if the word's base probability is not part of its own; (b, a) in order."""
    new = np.ones(len(b), bool)
    new[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1])
    prior = trie.pair(np.where(b[new] == end, -1, a[new]), b[new])[np.cumsum(new) - 1]
    out = np.empty(len(c), np.int64)
    for at in range(0, len(c), CHUNK):  # arrays of a chunk stay in the processor's cache
        some = slice(at, at + CHUNK)
        units, plain = trie.units(c[some], b[some], trie.pair(b[some], c[some]), prior[some])
        out[some] = 2 * units + ~plain
    return out


def answers(asked: DataFrame, counts, splits: dict[int, int], pairs: dict[int, tuple[int, list[str]]], total: int, distinct: int, path: str) -> DataFrame:
    """(block, shard, units) of the asked blocks: a shard's levels are built of all its trigrams, then each is looked up once."""

    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        numbered = counts.value
        parts = [unpacked(x.as_py()) for x in table.column("grams")]
        sizes = np.array([len(numbers[0]) for _, numbers in parts])
        found = [distinct_of(np.concatenate([x[x < 0] for x in words])) for words, _ in parts]
        rare, rare_n = np.concatenate(found), np.concatenate([unpacked(x.as_py())[1][0] for x in table.column("rare")])
        columns = [np.concatenate([words[k] for words, _ in parts]) for k in range(3)]
        n = np.concatenate([numbers[0] for _, numbers in parts])
        del parts, found
        dense = _Dense(len(numbered), columns)
        words, size = dense.words, len(dense.words)
        many = np.zeros(size, np.int64)
        many[words >= 0] = numbered[words[words >= 0]]
        many[dense.of(rare)] = rare_n
        (b, a, c), place = ranked([dense.of(x) for x in columns], size)
        del columns
        n = np.bincount(place, n, minlength=len(b)).astype(np.int64)
        end = int(dense.of(np.zeros(1, np.int64))[0])
        files, top = open_store(path)
        shared = {}
        for word in np.flatnonzero(np.isin(words, np.array(sorted(pairs), np.int64))).tolist():
            wanted = distinct_of(c[np.searchsorted(b, word): np.searchsorted(b, word, side="right")])
            if not len(wanted):
                continue
            kinds, names = pairs[int(words[word])]
            last, last_n = [], []
            for name in names:
                with files.open_input_file(f"{top}/{name}") as source:
                    (keys,), (some_n,) = unpacked(source.read())
                at = dense.of(keys)
                here = (at >= 0) & np.isin(at, wanted)
                last.append(at[here])
                last_n.append(some_n[here])
            shared[word] = kinds, np.concatenate(last), np.concatenate(last_n)
        learned = n > 0
        trie = build_shard([x[learned] for x in (b, a, c, n)], many, end, shared, total, distinct)
        units = shard_units(trie, b, a, c, end)[place]
        out = [packed(np.zeros(0, np.int64), [], [x]) for x in np.split(units, np.cumsum(sizes)[:-1])]
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "units": pa.array(out, pa.binary())})

    return asked.groupBy("shard").applyInArrow(answer, "block long, shard long, units binary")


def score_documents(docs: DataFrame, learn: Column, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score) per row; the model learns from the rows where ``learn`` holds."""
    spark = docs.sparkSession
    arrow_rows(spark)
    path = scratch_dir(spark, f"llm-lm-{uuid.uuid4().hex}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    blocks = text_blocks(rows, path)
    number_of, tokens_of = blocks.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    spread = lambda x, n=1: x.select("block").repartition(max(1, min(number_of, 2 * spark.sparkContext.defaultParallelism), number_of // n))  # noqa: E731 - n blocks a task
    table = stored(word_counts(spread(blocks, 8), path).withColumn("id", F.monotonically_increasing_id()), "word-counts", "zstd")
    learned = table.filter("n > 0")
    total, distinct = learned.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = int(total or 0), int(distinct)
    top = learned.filter(F.col("n") >= share * total).orderBy(F.desc("n"), "word").select("word", "n").toArrow()
    vocabulary, counts = top.column("word").to_pylist(), top.column("n").to_numpy()
    number = spark.sparkContext.broadcast(pa.array(vocabulary, pa.large_binary()))
    ends = learned.filter(F.col("word") == F.lit(bytearray(END))).first()
    end_n = ends["n"] if ends else 0
    numbered = spark.sparkContext.broadcast(np.concatenate([[end_n], counts]).astype(np.int64))
    most = SHARD_TOKENS // 4
    shards = max(1, -(-int(tokens_of or 0) // SHARD_TOKENS))
    place = {w: i + 1 for i, w in enumerate(vocabulary)}
    common = table.filter((F.col("uses") > most) & (F.col("word") != F.lit(bytearray(END)))).collect()
    splits = {place.get(bytes(r["word"]), ~r["id"]): -(-r["uses"] // most) for r in common}
    counted = with_counts(spread(blocks), table.filter((F.col("n") == 0) | (F.col("n") < share * total)).select("word", "n", "id"), number, numbered, path)
    pairs = split_pairs(spread(counted), splits, len(vocabulary) + 1, path)
    asked = asked_blocks(spread(counted), splits, shards, path)

    def finish(key: tuple[pa.Scalar, ...], found: pa.Table) -> pa.Table:
        block = _Block(path, key[0].as_py(), counts=True)
        asks = _Asked(block, splits, shards)
        units = dict(zip(found.column("shard").to_pylist(), found.column("units"), strict=True))
        answer = np.empty(len(asks.columns[0]), np.int64)
        for shard, at in asks.shards:
            answer[at] = unpacked(units[shard].as_py())[1][0]
        base = np.log10((asks.counts + 0.5) / (total + 0.5 * (distinct + 1)))
        gain = (answer >> 1) / -STEPS - np.where(answer & 1, base[asks.columns[2]], 0.0)
        _, row = _each(block.docs)
        known, plain, model = (np.bincount(row, x, minlength=block.docs.num_rows) for x in (
            asks.counts[asks.last] > 0, base[asks.last], gain[asks.place]))
        return pa.Table.from_arrays([block.docs.column("doc_id"), block.docs.column("size"), pa.array(known.astype(np.int64)),
                                     pa.array(plain), pa.array(plain + model)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    schema = T.StructType([rows.schema["doc_id"], *T.StructType.fromDDL("n_tokens long, n_known long, base_score double, score double").fields])
    scores = stored(answers(asked, numbered, splits, pairs, total, distinct, path).groupBy("block").applyInArrow(finish, schema), "lm-scores")
    return scores.select(F.col("doc_id").alias(id_col), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
