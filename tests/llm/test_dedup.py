"""Line, substring and byte dedup, and SimHash groups, against brute force on awkward documents."""

import random
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pricelake.llm.columnwise import dedup_bytes, repeated_windows
from pricelake.llm.components import components
from pricelake.llm.line_dedup import (
    CuckooFilter, build_filters, change_counts, dedup_lines, drop_frequent_lines, reference_counts, update_filters)
from pricelake.llm.seed_extend import dedup_substrings
from pricelake.llm.simhash import links, near_duplicates

from .messy import LOWER, by_row, frame, texts, words


def _lines(rows, min_docs):
    def keys(t):
        return [x.strip(" \t\n\v\f\r").translate(LOWER) for x in (t or "").split("\n")]

    held = Counter(k for _, t in rows for k in set(keys(t)) if k)
    out = []
    for i, t in rows:
        parts, some = (t or "").split("\n"), keys(t)
        keep = [p for p, k in zip(parts, some, strict=True) if held[k] < min_docs]
        out.append((i, len(parts), len(parts) - len(keep), "\n".join(keep)))
    return by_row(out)


def test_line_dedup_equals_brute_force(spark):
    rows = texts()
    for least in (2, 10):
        out = dedup_lines(frame(spark), min_docs=least)
        assert by_row(tuple(r) for r in out.select("doc_id", "n_lines", "n_dropped", "text").collect()) == _lines(rows, least)
    assert set(out.columns) == set(frame(spark).columns) | {"n_dropped"}
    assert dedup_lines(frame(spark, []), min_docs=2).count() == 0


def test_line_counts_are_reversible(spark):
    rows = texts()
    first, more = reference_counts(frame(spark, rows[:40])), reference_counts(frame(spark, rows[40:]))
    both = change_counts(first, inserted=more)
    assert {tuple(r) for r in both.collect()} == {tuple(r) for r in reference_counts(frame(spark)).collect()}
    back = change_counts(both, deleted=more)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in first.collect()}
    # Filters follow the table, and a filtered drop equals an unfiltered one.
    start = build_filters(first.filter("n >= 2"), keys_per_shard=3)
    moved = update_filters(start, first, both, 2)
    frequent = both.filter("n >= 2")
    one = drop_frequent_lines(frame(spark), frequent, moved).select("doc_id", "n_dropped", "text")
    assert by_row(map(tuple, one.collect())) == by_row((a, c, d) for a, _, c, d in _lines(rows, 2))
    plain = drop_frequent_lines(frame(spark), frequent, moved, filter_bytes=1).select("doc_id", "n_dropped", "text")
    assert by_row(map(tuple, plain.collect())) == by_row(map(tuple, one.collect()))


def test_cuckoo_filter_inserts_and_deletes():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.int64).astype(np.uint64) * np.uint64(2654435761))
    held = CuckooFilter.holding(keys)
    assert held.contains(keys).all()
    held.delete(keys[:2500])
    assert held.contains(keys[2500:]).all()
    assert held.contains(keys[:2500]).mean() < 0.01
    held.insert(keys[:2500])
    assert held.contains(keys).all()


def test_substring_dedup_equals_brute_force(spark):
    rows = texts()
    for width in (5, 13):
        least = {}
        for i, t in rows:
            w = words(t)
            for s in range(len(w) - width + 1):
                if i is not None:
                    key = tuple(w[s: s + width])
                    least[key] = min(least.get(key, i), i)
        expected = []
        for i, t in rows:
            w, gone = words(t), set()
            for s in range(len(w) - width + 1):
                if i is not None and least[tuple(w[s: s + width])] < i:
                    gone.update(range(s, s + width))
            expected.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
        out = dedup_substrings(frame(spark), width=width)
        assert by_row(map(tuple, out.collect())) == by_row(expected)
        assert sum(e[2] for e in expected)
    assert dedup_substrings(frame(spark, []), width=13).count() == 0


def _bytes_removed(rows, width):
    raw = [(t or "").encode() for _, t in rows]
    held = Counter(t[s: s + width] for t in raw for s in range(len(t) - width + 1))
    out = []
    for (i, _), t in zip(rows, raw, strict=True):
        mark = np.zeros(len(t) + 1, dtype=int)
        for s in range(len(t) - width + 1):
            if held[t[s: s + width]] > 1:
                mark[s] += 1
                mark[s + width] -= 1
        gone = np.cumsum(mark[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return by_row(out)


def test_byte_dedup_equals_brute_force(spark):
    rows = texts()
    expected = _bytes_removed(rows, 200)
    assert sum(e[2] for e in expected)
    # largest=0: every collection takes the way of the very large ones.
    for largest in (40_000, 0):
        out = [(*r[:4], bytes(r[4])) for r in dedup_bytes(frame(spark), width=200, largest=largest).collect()]
        assert by_row(out) == expected
    assert dedup_bytes(frame(spark, []), width=200).count() == 0


def test_columns_find_aligned_repeats():
    rng = random.Random(2)
    width, anchor = 12, 3
    group, shift, segments = [], [], []
    for g in range(30):
        base = [rng.choice(b"ab") for _ in range(2 * width - anchor)]
        for _ in range(rng.randrange(1, 9)):
            s = list(base)
            for _ in range(rng.randrange(3)):
                s[rng.randrange(len(s))] = rng.choice(b"abc")
            s[width - anchor: width] = b"xyz"
            cut = rng.randrange(0, width - anchor + 1)
            end = rng.randrange(cut + width, 2 * width - anchor + 1)
            group.append(g)
            shift.append(width - anchor - cut)
            segments.append(bytes(s[cut:end]))
    row, place = repeated_windows(np.array(group), np.array(shift), segments, width, anchor)
    found = set(zip(row.tolist(), place.tolist(), strict=True))
    at = Counter()
    for g, h, s in zip(group, shift, segments, strict=True):
        for p in range(len(s) - width + 1):
            at[g, p - h, s[p: p + width]] += 1
    expected = {(r, p) for r, (g, h, s) in enumerate(zip(group, shift, segments, strict=True))
                for p in range(len(s) - width + 1) if at[g, p - h, s[p: p + width]] > 1}
    assert found == expected and expected


def _fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i: i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _groups(marks, radius):
    left, out = set(marks), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            a = todo.pop()
            seen.add(a)
            near = {b for b in left if bin(a ^ b).count("1") <= radius}
            left -= near
            todo.extend(near)
        out.update(dict.fromkeys(seen, frozenset(seen)))
    return out


def test_simhash_equals_brute_force(spark):
    rows = texts()
    marks = [_fingerprint(t) for _, t in rows]
    for radius in (2, 12):
        group = _groups(marks, radius)
        head = {}
        for (i, _), m in zip(rows, marks, strict=True):
            if i is not None:
                head[group[m]] = min(head.get(group[m], i), i)
        expected = [(i, f"{m:016x}", head.get(group[m])) for (i, _), m in zip(rows, marks, strict=True)]
        assert by_row(map(tuple, near_duplicates(frame(spark), shingle=3, radius=radius).collect())) == by_row(expected)
    assert near_duplicates(frame(spark, []), radius=2).count() == 0


def test_large_buckets_lose_no_link(spark):
    rng = random.Random(3)
    near = {0x00FF00FF12345678 ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) for _ in range(300)}
    marks = sorted(near | {rng.getrandbits(64) for _ in range(50)})
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    df = spark.createDataFrame([(m, i) for i, m in enumerate(signed)], "fp long, node long")
    group = _groups(marks, 2)
    expected = {i: min(k for k, n in enumerate(marks) if group[n] == group[m]) for i, m in enumerate(marks)}
    for tile in (8, 4096):
        found = {r["node"]: r["component"] for r in components(links(df, 2, tile=tile)).collect()}
        assert {i: found.get(i, i) for i in expected} == expected


def test_components_of_a_long_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    out = components(edges.unionByName(spark.createDataFrame([(500, 501), (501, 500), (7, 7)], "a long, b long")))
    found = {r["node"]: r["component"] for r in out.collect()}
    assert all(found.get(i, i) == 0 for i in range(201)) and found[501] == 500


