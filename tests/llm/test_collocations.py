"""Phrase collocations against plain counting; the FM-index against plain search."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pricelake.llm import collocations as col
from pricelake.llm.fm_index import both_transforms, extend, inside, word_intervals

from .messy import LOWER, by_row, frame, texts


def test_index_extends_to_all_phrases_and_no_others():
    rng = np.random.default_rng(4)
    for symbols, length in ((3, 60), (6, 200), (2, 9), (1, 4)):
        ids = np.concatenate([[0], rng.integers(0, symbols, length)]).astype(np.int32)
        depth = 5
        forward, backward = both_transforms(ids, depth)
        begin, size = word_intervals(ids, int(ids.max()) + 1)
        seen = np.flatnonzero(size)[np.flatnonzero(size) > 0]
        phrases, lo, rlo, n = [(int(s),) for s in seen], begin[seen], begin[seen], size[seen]
        ring = ids.tolist() * 2
        for k in range(2, depth + 1):
            right = k % 2 == 0
            which, word, a, b, n2 = extend(backward if right else forward, rlo if right else lo, lo if right else rlo, n)
            assert inside(a, rlo if right else lo, n).all()  # every part of a phrase that occurs, occurs
            phrases = [phrases[p] + (w,) if right else (w, *phrases[p]) for p, w in zip(which.tolist(), word.tolist())]
            lo, rlo, n = (b, a, n2) if right else (a, b, n2)
            plain = Counter(tuple(ring[i: i + k]) for i in range(len(ids)))
            plain = {p: c for p, c in plain.items() if 0 not in p}
            assert dict(zip(phrases, n.tolist())) == plain
            # Intervals begin after the rotations that sort before the phrase, read forwards or backwards.
            rotated = [tuple(ring[i: i + depth]) for i in range(len(ids))]
            mirrored = [tuple(ring[len(ids) + i - depth + 1: len(ids) + i + 1][::-1]) for i in range(len(ids))]
            for p, x, y in zip(phrases, lo.tolist(), rlo.tolist()):
                assert x == sum(r[:k] < p for r in rotated) and y == sum(m[:k] < p[::-1] for m in mirrored)
    assert inside(np.array([1]), np.zeros(0, int), np.zeros(0, int)).tolist() == [False]


def plain_counts(rows, most):
    counts, total = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, most + 1):
                for s in range(len(words) - k + 1):
                    key = (lang, tuple(words[s: s + k]))
                    counts[key] = counts.get(key, 0) + 1
    return counts, total


def plain_collocations(rows, least, most, top, share):
    f, total = plain_counts(rows, most)
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = []
    for (lang, words), a in candidates.items():
        score, k = min((1000 * a * total[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words)))
        held = any(lang == other and len(longer) > len(words) and 100 * b >= share * a
                   and any(longer[s: s + len(words)] == words for s in range(len(longer)))
                   for (other, longer), b in candidates.items())
        if not held:
            out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], total[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        rows = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows[:top])]
    return by_row(ranked)


def sample():
    rng = random.Random(11)
    vocabulary = ["new", "York", "city", "of", "the", "ÉTÉ", "a.b", "x\x1cy", "漢字"]
    rows = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))).replace("of the", rng.choice(["of the", "of, the", "of\tthe\n"])),
             rng.choice(["en", "en", "de", None, "und"])) for _ in range(150)]
    rows += [("New York City of the world " * 9, "en"), (None, "en"), ("", None), (" .,\n\t", "fr"), ("solo", "fr")]
    return rows + rows[:30] + [rows[2]] * 40


@pytest.mark.parametrize("least,most,share,shard", [(6, 5, 100, 1 << 21), (4, 5, 80, 300), (3, 2, 50, 40), (2, 7, 100, 900)])
def test_collocations_equal_plain_counting(spark, monkeypatch, least, most, share, shard):
    monkeypatch.setattr(col, "SHARD_WORDS", shard)
    monkeypatch.setattr(col, "TASK_WORDS", shard + shard // 2)
    rows = sample()
    docs = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, n long, phrase string").repartition(5)
    counts, total = col.count_phrases(docs, least, most)
    f, n = plain_counts(rows, most)
    assert by_row(map(tuple, counts.collect())) == by_row((lang, len(w), " ".join(w), a) for (lang, w), a in f.items() if a >= least)
    assert {k: v for k, v in map(tuple, total.collect()) if v} == {k: v for k, v in n.items() if v}
    got = col.collocations(docs, least, most, top=25, share=share)
    assert by_row(map(tuple, got.collect())) == plain_collocations(rows, least, most, 25, share)


def test_awkward_and_empty_tables(spark):
    rows = texts()
    got = col.collocations(frame(spark, rows), min_count=5)
    assert by_row(map(tuple, got.collect())) == plain_collocations([(t, "en") for _, t in rows], 5, 5, 2000, 100)
    assert col.collocations(frame(spark, []), min_count=5).collect() == []
    assert col.collocations(frame(spark, [(1, None), (2, "")]), min_count=1).collect() == []


def test_products_beyond_64_bits_are_exact(spark, monkeypatch):
    big = 3 * 10**11
    counts = spark.createDataFrame([("en", 1, "a", big + 7), ("en", 1, "b", big - 11), ("en", 2, "a b", big - 12)],
                                   "lang string, size int, phrase string, f long")
    total = spark.createDataFrame([("en", 10**13 + 3)], "lang string, n long")
    monkeypatch.setattr(col, "count_phrases", lambda *a: (counts, total))
    (row,) = col.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    assert row["score"] == 1000 * (big - 12) * (10**13 + 3) // ((big + 7) * (big - 11))


def test_extensions_travel_as_blocks_not_as_rows(spark, monkeypatch):
    rows, kept = {}, col.stored

    def counted(df, name, *more):
        out = kept(df, name, *more)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(col, "stored", counted)
    monkeypatch.setattr(col, "BUCKETS", 3, raising=False)
    rng = random.Random(5)
    texts = [(" ".join(f"w{rng.randrange(80)}" for _ in range(400)), "en") for _ in range(40)]
    docs = spark.createDataFrame(texts, "text string, lang string").repartition(2)
    counts, _ = col.count_phrases(docs, 6, 3)
    f, _ = plain_counts(texts, 3)
    assert by_row(map(tuple, counts.collect())) == by_row((lang, len(w), " ".join(w), a) for (lang, w), a in f.items() if a >= 6)
    shards = 2
    assert sum(len(w) == 2 for _, w in f) > 5000  # pairs, of which each shard has most
    assert rows["fm-shards"] <= shards * 4 and rows["grown2"] <= shards * 4 and rows["grown3"] <= shards * 4


def test_packed_pairs_come_back():
    part, word, n = (np.array(x, np.int64) for x in ([2, 2, 2, 5, 9, 9], [0, 7, 1 << 40, 3, 4, 5], [1, 1 << 33, 2, 1, 1, 3]))
    assert [x.tolist() for x in col.unpack_pairs(col.pack_pairs(part, word, n))] == [part.tolist(), word.tolist(), n.tolist()]
    assert [len(x) for x in col.unpack_pairs(col.pack_pairs(*[part[:0]] * 3))] == [0, 0, 0]
