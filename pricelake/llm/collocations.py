"""Phrase collocations: an FM-index over word ids per shard, counts summed over shards.

Each task cuts its documents into shards of one language and bounded size and
writes a bidirectional FM-index of each to the shared folder. Phrases grow by a
word a round: a shard extends the intervals of the phrases that are frequent in
the whole corpus, to the right and to the left in turn, and keeps an extension
only if its other part is frequent, too (its interval lies in that part's).
Its extensions and their counts go packed, a block a bucket, to the task of the bucket, which
sums the counts of all shards, numbers the frequent ones and tells each shard which of
its block these are. So a row stands for a block, not for a phrase, and a shard works out the
intervals again instead of keeping them. No text is shuffled, and no shard or bucket depends on how common a word or a language is.

Null text has no words, null languages are ``und``. Repeated rows count each
time. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.llm.common import arrow_rows, pieces, stored
from pricelake.llm.files import open_store
from pricelake.llm.fm_index import both_transforms, extend, inside, stable_order, word_intervals
from pricelake.llm.ngram_trie import packed, unpacked
from pricelake.session import scratch_dir

#: Words of a shard, and words a task holds over all languages before its largest shard closes.
SHARD_WORDS, TASK_WORDS = 1 << 21, 3 << 20

#: Bytes between pieces; blanks between words (fixed values). No UTF-8 text holds the byte 0xFF.
BREAKS, BLANKS, BREAK = b".,;:!?\n\x0b\x0c\r", b" \t", b"\xff"
_BYTES = bytes(0xFF if b in BREAKS else 0x20 if b in BLANKS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

#: Buckets of words and phrases: so many at least, and one for so many bytes of text.
BUCKETS, BUCKET_BYTES = 64, 24 << 20
#: The bucket number of a shard's own row, which no other shard reads.
OWN = -1

#: A shard's words, a row a bucket; its own row has the language, the number of words and the intervals.
WORDS = T.StructType([T.StructField("shard", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("lang", T.StringType()),
                      T.StructField("n", T.LongType()), T.StructField("words", T.BinaryType()), T.StructField("data", T.BinaryType())])
#: A shard's extensions, a row a bucket; its own row has its frequent phrases and words.
GROWN = T.StructType([T.StructField("shard", T.LongType()), T.StructField("bucket", T.IntegerType()),
                      T.StructField("words", T.BinaryType()), T.StructField("data", T.BinaryType())])
#: A bucket's frequent phrases (no shard) and, for each shard, which of its block they are (``data``).
FOUND = T.StructType([T.StructField("shard", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("data", T.BinaryType()),
                      T.StructField("lang", T.StringType()), T.StructField("phrase", T.StringType()),
                      *[T.StructField(c, T.LongType()) for c in ("part", "word", "id", "f")]])
_KINDS = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
_NO_KEYS = np.zeros(0, np.int64)


def _table(schema: T.StructType, rows: int, **columns) -> pa.Table:
    """A table of ``schema``; a column not given is NULL, one value stands for all rows."""
    out = []
    for f in schema.fields:
        kind, c = _KINDS[f.dataType], columns.get(f.name)
        out.append(pa.array(c, kind) if isinstance(c, (list, np.ndarray)) else pa.repeat(pa.scalar(c, kind), rows))
    return pa.Table.from_arrays(out, names=schema.fieldNames())


def _pack(*columns: np.ndarray) -> bytes:
    return packed(_NO_KEYS, [], list(columns))


def _unpack(data: bytes) -> list[np.ndarray]:
    return unpacked(data)[1]


def pack_pairs(part: np.ndarray, word: np.ndarray, n: np.ndarray) -> bytes:
    """Pairs in order with their counts as bytes; within a part, words are written as steps."""
    step = word.copy()
    step[1:] -= np.where(part[1:] == part[:-1], word[:-1], 0)
    return _pack(part, step, n)


def unpack_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    part, step, n = _unpack(data)
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else _NO_KEYS
    word = np.cumsum(step)
    return part, word - np.repeat((word - step)[first], np.diff(np.append(first, len(part)))), n


def piece_words(text: str | bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased, in order; ``BREAK`` stands between pieces."""
    data = text.encode() if isinstance(text, str) else text
    return data.translate(_BYTES).replace(BREAK, b" \xff ").split()


class _Shard:
    """Word ids of one language as they come in; id 0 is the break."""

    def __init__(self):
        self.ids: defaultdict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.ids[BREAK]  # noqa: B018 - takes id 0
        self.runs, self.size = [np.zeros(1, np.int32)], 1

    def add(self, texts: list[str]) -> None:
        words = piece_words(BREAK.join([t.encode() for t in texts]) + BREAK)
        run = np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words))
        run = run[(run > 0) | (np.concatenate([[1], run[:-1]]) > 0)]
        self.runs.append(run)
        self.size += len(run)

    def close(self, store, folder: str, depth: int, lang: str, buckets: int) -> pa.Table:
        """Write the index file; the rows of ``WORDS``."""
        ids = np.concatenate(self.runs)
        words, size = list(self.ids)[1:], np.bincount(ids, minlength=len(self.ids))
        often = np.argsort(-size[1:], kind="stable")  # frequent words get small numbers, which take fewer bytes
        number = np.zeros(len(size), np.int32)
        number[often + 1] = np.arange(1, len(size))
        ids, words = number[ids], [words[i] for i in often.tolist()]
        forward, backward = both_transforms(ids, depth)
        shard = uuid.uuid4().int >> 65  # of this attempt alone
        table = pa.table({"forward": [_pack(forward)], "backward": [_pack(backward)]})
        with store.open_output_stream(f"{folder}/{shard:016x}.arrow") as out:
            with pa.ipc.new_file(out, table.schema) as writer:
                writer.write_table(table)
        begin, size = word_intervals(ids, len(self.ids))
        order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        bucket = np.fromiter((zlib.crc32(words[i]) % buckets for i in order.tolist()), np.int64, len(words))
        by_bucket, bucket = stable_order(bucket)
        order = order[by_bucket]
        numbers, texts, blocks = [OWN], [None], [_pack(bucket, order + 1, begin[1:])]
        for at in np.split(np.arange(len(order)), np.flatnonzero(np.diff(bucket)) + 1):
            if len(at):
                numbers.append(int(bucket[at[0]]))
                texts.append(_squeezed(b"\n".join([words[i] for i in order[at].tolist()])))
                blocks.append(_pack(size[1:][order[at]]))
        return _table(WORDS, len(numbers), shard=shard, bucket=numbers, lang=lang, n=[int(size[1:].sum()), *[None] * (len(numbers) - 1)],
                      words=texts, data=blocks)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _stretched(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def build_shards(docs: DataFrame, path: str, depth: int, buckets: int, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``WORDS`` of each shard; its index files lie under ``path``."""
    arrow_rows(docs.sparkSession)
    store, folder = open_store(path)
    store.create_dir(folder, recursive=True)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, top = open_store(path)
        shards: dict[str, _Shard] = {}

        def close(lang: str) -> Iterator[pa.RecordBatch]:
            yield from shards.pop(lang).close(files, top, depth, lang, buckets).to_batches()

        for batch in pieces(batches, "text"):
            texts = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts[lang].append(text or "")
            for lang, some in texts.items():
                if lang not in shards:
                    shards[lang] = _Shard()
                shards[lang].add(some)
                if shards[lang].size >= SHARD_WORDS:
                    yield from close(lang)
            while sum(s.size for s in shards.values()) >= TASK_WORDS:
                yield from close(max(shards, key=lambda k: shards[k].size))
        for lang in list(shards):
            yield from close(lang)

    return stored(slim.mapInArrow(build, WORDS), "fm-shards")


def _answers(shards: list[int], bucket: int, sizes: list[int], number: np.ndarray) -> dict[str, list]:
    """Rows that tell each shard the places in its block of the frequent phrases (``number`` not negative), and their numbers."""
    out = []
    for begin, size in zip(np.cumsum(sizes) - sizes, sizes, strict=True):
        mine = number[begin: begin + size]
        at = np.flatnonzero(mine >= 0)
        out.append(_pack(at, mine[at]) if len(at) else None)
    kept = [i for i, data in enumerate(out) if data is not None]
    return {"shard": [shards[i] for i in kept], "bucket": [bucket] * len(kept), "data": [out[i] for i in kept]}


def frequent_words(blocks: DataFrame, min_count: int, buckets: int) -> DataFrame:
    """``FOUND`` of the words of all shards: (lang, phrase, id, f) and the answers to the shards."""

    def add_up(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        group = group.sort_by("shard")
        shards, langs = group.column("shard").to_pylist(), group.column("lang").to_pylist()
        words, counts = [], []
        for lang, text, data in zip(langs, group.column("words"), group.column("data"), strict=True):
            some = pa.array(_stretched(text.as_py()).split(b"\n"), pa.large_binary())
            words.append(pc.binary_join_element_wise(pa.scalar(lang.encode(), pa.large_binary()), some, pa.scalar(b"\n", pa.large_binary())))
            counts.append(_unpack(data.as_py())[0])
        every = pa.concat_arrays(words).dictionary_encode()
        place = every.indices.to_numpy().astype(np.int64)
        total = np.zeros(len(every.dictionary), np.int64)
        np.add.at(total, place, np.concatenate(counts))
        kept = np.flatnonzero(total >= min_count)
        number = np.full(len(total), -1, np.int64)
        number[kept] = np.arange(len(kept))
        named = [x.rsplit(b"\n", 1) for x in every.dictionary.take(pa.array(kept)).to_pylist()]
        return pa.concat_tables([
            _table(FOUND, len(kept), bucket=bucket, lang=[x.decode() for x, _ in named], phrase=[x.decode() for _, x in named],
                   id=number[kept] * buckets + bucket, f=total[kept]),
            _answer_table(_answers(shards, bucket, [len(c) for c in counts], number[place]))])

    return blocks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add_up, FOUND)


def frequent_pairs(blocks: DataFrame, min_count: int, buckets: int) -> DataFrame:
    """``FOUND`` of the extensions of all shards: (part, word, id, f) and the answers to the shards."""

    def add_up(key: tuple, group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        group = group.sort_by("shard")
        every = [unpack_pairs(data.as_py()) for data in group.column("data")]
        part, word, n = (np.concatenate(x) for x in zip(*every, strict=True))
        order, pair = stable_order(part * (int(word.max()) + 1) + word)
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        first = np.flatnonzero(new)
        total = np.add.reduceat(n[order], first)
        kept = np.flatnonzero(total >= min_count)
        number = np.full(len(total), -1, np.int64)
        number[kept] = np.arange(len(kept))
        of_row = np.empty(len(order), np.int64)
        of_row[order] = number[np.cumsum(new) - 1]
        at = order[first[kept]]
        return pa.concat_tables([
            _table(FOUND, len(kept), bucket=bucket, part=part[at], word=word[at] * buckets + (bucket - part[at]) % buckets,
                   id=number[kept] * buckets + bucket, f=total[kept]),
            _answer_table(_answers(group.column("shard").to_pylist(), bucket, [len(x[0]) for x in every], of_row))])

    return blocks.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(add_up, FOUND)


def _answer_table(answers: dict[str, list]) -> pa.Table:
    return _table(FOUND, len(answers["shard"]), **answers)


def extensions(bwt: np.ndarray, phrases: list[np.ndarray], words: list[np.ndarray], to_right: bool, buckets: int) -> list[np.ndarray]:
    """[bucket, part, word, lo, rlo, n] in order: a shard's extensions of its frequent phrases by a frequent word.

    ``phrases`` (id, lo, rlo, n) are all its frequent phrases of one length, ``words`` (sym, id) its frequent words; an extension is
    kept if the phrase without the word at its other end is among ``phrases``. All tasks that work it out get the same order.
    """
    part, lo, rlo, size = phrases
    here, there = (rlo, lo) if to_right else (lo, rlo)
    phrase, sym, begin, other, count = extend(bwt, here, there, size)
    known = np.full(int(bwt.max()) + 1, -1, np.int64)
    known[words[0]] = words[1]
    keep = (known[sym] >= 0) & inside(begin, here, size)
    begin, other = (other, begin) if to_right else (begin, other)
    part, word = part[phrase][keep], known[sym][keep]
    order = stable_order(part * (int(word.max(initial=0)) + 1) + word)[0]
    order = order[stable_order(((part + word) % buckets)[order])[0]]
    return [x[order] for x in ((part + word) % buckets, part, word, begin[keep], other[keep], count[keep])]


def answered(bucket: np.ndarray, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, ids) of the frequent ones among rows in order of their ``bucket``."""
    places, ids = [_NO_KEYS], [_NO_KEYS]
    for b, data in zip(answers.column("bucket").to_pylist(), answers.column("data"), strict=True):
        at, number = _unpack(data.as_py())
        places.append(at + np.searchsorted(bucket, b))
        ids.append(number * buckets + b)
    return np.concatenate(places), np.concatenate(ids)


def grown(own: DataFrame, answers: DataFrame, path: str, size: int, buckets: int) -> DataFrame:
    """``GROWN``: each shard's extensions to phrases of ``size`` words, from its own rows of the round before and the answers to it."""

    def grow(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(GROWN, 0)
        shard = key[0].as_py()
        files, top = open_store(path)
        with files.open_input_file(f"{top}/{shard:016x}.arrow") as source:
            index = pa.ipc.open_file(source).read_all()

        def transform(to_right: bool) -> np.ndarray:
            return _unpack(index.column("backward" if to_right else "forward")[0].as_py())[0].astype(np.int32)

        def longer(phrases: list[np.ndarray], words: list[np.ndarray], k: int) -> list[np.ndarray]:
            return extensions(transform(k % 2 == 0), phrases, words, k % 2 == 0, buckets)

        right, had = right.sort_by("bucket"), _unpack(left.column("data")[0].as_py())
        if size == 2:
            bucket, sym, begin = had
            at, ids = answered(bucket, right, buckets)
            by_sym = np.argsort(sym[at])  # words in order are packed as steps
            sym, ids = sym[at][by_sym], ids[by_sym]
            lo, n = begin[sym - 1], np.diff(np.append(begin, len(transform(True))))[sym - 1]
            words, phrases = [sym, ids], [ids, lo, lo, n]
        else:
            words = _unpack(left.column("words")[0].as_py())
            bucket, _, _, *places = longer(had, words, size - 1)
            at, ids = answered(bucket, right, buckets)
            phrases = [ids, *(x[at] for x in places)]
        order = np.argsort(phrases[0])  # numbers in order are packed as steps
        phrases = [x[order] for x in phrases]
        rows = [(OWN, _pack(*words), _pack(*phrases))]
        bucket, part, word, _, _, count = longer(phrases, words, size)
        for at in np.split(np.arange(len(bucket)), np.flatnonzero(np.diff(bucket)) + 1):
            if len(at):
                rows.append((int(bucket[at[0]]), None, pack_pairs(part[at], word[at] // buckets, count[at])))
        numbers, texts, blocks = map(list, zip(*rows, strict=True))
        return _table(GROWN, len(rows), shard=shard, bucket=numbers, words=texts, data=blocks)

    own, answers = own.select("shard", "words", "data"), answers.select("shard", "bucket", "data")
    return own.repartition(buckets, "shard").groupBy("shard").cogroup(
        answers.repartition(buckets, "shard").groupBy("shard")).applyInArrow(grow, GROWN)


def count_phrases(docs: DataFrame, min_count: int = 100, max_words: int = 5, text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, size, phrase, f) of all phrases of 1 to ``max_words`` words found ``min_count`` times or more, (lang, n) words in all)."""
    path = scratch_dir(docs.sparkSession, f"llm-fm-{uuid.uuid4().hex}")
    size_of_text = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(BUCKETS, size_of_text // BUCKET_BYTES)
    sent = build_shards(docs, path, max_words, buckets, text_col, lang_col)
    total = sent.filter(F.col("bucket") == OWN).groupBy("lang").agg(F.sum("n").alias("n"))
    found = stored(frequent_words(sent.filter(F.col("bucket") != OWN).select("shard", "bucket", "lang", "words", "data"), min_count, buckets), "words")
    frequent = found.filter("shard IS NULL").select("lang", "phrase", "id", "f")
    every, single = [frequent], frequent.select(F.col("id").alias("word"), F.col("phrase").alias("__word"))
    for size in range(2, max_words + 1):
        sent = stored(grown(sent.filter(F.col("bucket") == OWN), found.filter("shard IS NOT NULL"), path, size, buckets), f"grown{size}")
        found = stored(frequent_pairs(sent.filter(F.col("bucket") != OWN).select("shard", "bucket", "data"), min_count, buckets), f"found{size}")
        pairs = found.filter("shard IS NULL").select("part", "word", "id", "f")
        if pairs.isEmpty():
            break
        parts = frequent.select(F.col("id").alias("part"), "lang", F.col("phrase").alias("__part"))
        ends = ("__part", "__word") if size % 2 == 0 else ("__word", "__part")
        frequent = stored(pairs.join(parts, "part").join(single, "word").select(
            "lang", F.concat_ws(" ", *ends).alias("phrase"), "id", "f"), f"phrases{size}")
        every.append(frequent)
    out = None
    for size, one in enumerate(every, 1):
        one = one.select("lang", F.lit(size).alias("size"), "phrase", "f")
        out = one if out is None else out.unionByName(one)
    return out, total


def collocations(docs: DataFrame, min_count: int = 100, max_words: int = 5, top: int = 2000, share: int = 100,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` collocations.

    A phrase of 2 to ``max_words`` words found a >= ``min_count`` times scores
    floor(1000 * a * n / (l * r)) at its weakest cut into two parts found l
    and r times, n being the language's words. One whose words lie in a longer
    candidate found at least ``share`` percent as often goes: the
    candidates one word longer decide this, since any longer one is no more frequent than they.
    Exact: products are decimals of 38 digits (counts below 10**15).
    """
    counts, total = count_phrases(docs, min_count, max_words, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    cuts = counts.filter("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), words.alias("__words")).select(
        "lang", "size", "phrase", "a", "__words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "size", "phrase", "a", "k", F.array_join(F.slice("__words", F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice("__words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"))
    # Every part of a frequent phrase is frequent, so both joins find each part.
    cuts = stored(cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
                  .join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"]), "cuts")
    longer = cuts.filter("size > 2")
    held = longer.filter((F.col("k") == F.col("size") - 1) & (100 * F.col("a") >= share * F.col("l"))).select("lang", F.col("first").alias("phrase"))
    held = held.unionByName(longer.filter((F.col("k") == 1) & (100 * F.col("a") >= share * F.col("r"))).select("lang", F.col("rest").alias("phrase")))

    def exact(c: str):
        return F.col(c).cast("decimal(15,0)")

    score = F.call_function("div", exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)"), exact("l") * exact("r"))
    weakest = cuts.join(total, "lang").withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("__cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (weakest.join(held.distinct(), ["lang", "phrase"], "left_anti")
            .select("lang", "phrase", "a", "__cut.l", "__cut.r", "n", "__cut.score")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
