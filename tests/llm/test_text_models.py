"""Decontamination, quality rules, LM scoring, toxicity, BPE and personal data against brute force on awkward documents."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import decontaminate, pii, toxicity
from pricelake.llm.bpe import Vocabulary, decode_documents, encode_documents, encode_text
from pricelake.llm.decontaminate import find_contamination
from pricelake.llm.ngram_trie import EliasFano, build_levels, open_trie, score_documents, tokens
from pricelake.llm.quality import assess

from .messy import by_row, frame, texts, words

tiktoken = pytest.importorskip("tiktoken")
public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


# --- benchmark decontamination

def _marked(t):
    return [x.decode() for x in re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())]


def _hits(rows, items, window):
    held = {}
    for item, t in items:
        w = _marked(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            held.setdefault(tuple(w[s: s + n]), set()).add(item)
    out = []
    for i, t in rows:
        w, gone, found = _marked(t), set(), set()
        for n in {len(k) for k in held}:
            for s in range(len(w) - n + 1):
                if (got := held.get(tuple(w[s: s + n]))) is not None:
                    gone.update(range(s, s + n))
                    found |= got
        out.append((i, len(w), len(gone), sorted(str(x) for x in found if x is not None)))
    return by_row(out)


def test_decontamination_equals_brute_force(spark, monkeypatch):
    rows = texts()
    long = rows[7][1]
    items = [(1, " ".join(_marked(long)[2:20])), (2, "Word"), (3, "of the"), (4, None), (5, ""), (6, "pass3 pass4, PASS5"),
             (7, " ".join(f"pass{i}" for i in range(30, 55))), (7, "unseen words " * 6), (8, "x " * 30), (None, "one"),
             (10, " ".join(_marked(rows[3][1])[-9:])), (11, "word word word")]
    bench = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, words string")
    expected = _hits(rows, items, 10)
    out = find_contamination(frame(spark), bench, window=10)
    assert by_row((r[0], r[1], r[2], list(r[3])) for r in out.collect()) == expected
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 20)
    out = find_contamination(frame(spark), bench, window=10)
    assert by_row((r[0], r[1], r[2], list(r[3])) for r in out.collect()) == expected
    none = find_contamination(frame(spark), bench.limit(0), window=10)
    assert by_row((r[0], r[1], r[2], list(r[3])) for r in none.collect()) == by_row((i, n, 0, []) for i, n, _, _ in expected)
    assert find_contamination(frame(spark, []), bench, window=10).count() == 0


# --- quality rules

def test_quality_base_equals_brute_force(spark):
    expected = []
    for i, t in texts():
        w = words(t)
        grams = Counter(tuple(w[k: k + 3]) for k in range(len(w) - 2))
        hit = {p for k in range(len(w) - 2) if grams[tuple(w[k: k + 3])] > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        expected.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(hit), failed))
    out = assess(frame(spark)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert by_row(map(tuple, out.collect())) == by_row(expected)
    assert assess(frame(spark, [])).count() == 0


def test_quality_lines(spark):
    rng = random.Random(2)

    def sentence(i):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(12)) + f" {i}."

    clean = "\n".join(sentence(i) for i in range(8))
    nav = " | ".join(f"Entry{i}" for i in range(60)) + "."
    rows = [(1, clean), (2, clean + "\nAll rights reserved.\nHome | About | Contact\nno end"), (3, nav + "\nShort end."),
            (4, "\n".join(sentence(i).upper().replace(" ", "!! ") for i in range(8))),
            (5, "\n".join(sentence(i).replace(" ", "*** ") + "###" for i in range(8)))]
    out = {r["doc_id"]: r for r in assess(frame(spark, rows)).collect()}
    assert out[1]["kept"] and out[1]["text"] == clean and out[1]["n_failed_lines"] == 0
    assert out[2]["kept"] and out[2]["text"] == clean and out[2]["n_failed_lines"] == 3
    assert not out[3]["kept"] and not out[4]["kept"] and not out[5]["kept"]


# --- LM scoring

def test_lm_base_equals_brute_force(spark):
    rows = texts()
    learn = [i is not None and zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in rows]
    split = [[*tokens(t), b"\n"] for _, t in rows]
    count = Counter(x for w, use in zip(split, learn, strict=True) if use for x in w)
    total, bottom = sum(count.values()), sum(count.values()) + 0.5 * (len(count) + 1)
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 1, F.lit(False))
    out = score_documents(frame(spark), fold, share=1e-3).collect()
    expected = [(i, len(w), sum(x in count for x in w), total, round(sum(math.log10((count[x] + 0.5) / bottom) for x in w), 6))
                for (i, _), w in zip(rows, split, strict=True)]
    assert by_row((*r[:4], round(r[4], 6)) for r in out) == by_row(expected)
    assert all(r["score"] < 0 for r in out)
    assert score_documents(frame(spark, []), fold).count() == 0
    untrained = score_documents(frame(spark, rows[:5]), F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] == r["base_score"] for r in untrained)


def test_trie_probabilities_sum_to_one():
    rng = np.random.default_rng(4)
    size = 12
    text = rng.integers(0, size, 4000) * rng.integers(0, 2, 4000)
    counts = np.bincount(text, minlength=size)
    pairs, pair_counts = np.unique(text[:-1] * size + text[1:], return_counts=True)
    place = np.searchsorted(pairs, text[:-1] * size + text[1:])
    triples, triple_counts = np.unique(place[:-1] * size + text[2:], return_counts=True)
    keep = triple_counts > 5
    trie = open_trie(build_levels(counts, pairs, pair_counts, triples[keep], triple_counts[keep], len(text), size))
    for a in range(size):
        for b in range(size):
            word = np.array([x for w in range(size) for x in (a, b, w)])
            before = np.array([x for _ in range(size) for x in (0, a, b)])
            head = np.tile([True, False, False], size)
            p = 10 ** trie.score(word, before, head)[2::3]
            # What an unknown word would get is the rest.
            assert 0.97 < p.sum() < 1.003


def test_elias_fano_round_trip_and_search():
    rng = np.random.default_rng(0)
    for n, top in ((1, 1), (5, 10), (1000, 50), (1000, 10**12), (3, 10**15)):
        values = np.sort(rng.integers(0, top, n))
        assert (EliasFano.of(values).get(np.arange(n)) == values).all()
        distinct = np.unique(values)
        ask = np.concatenate([distinct, rng.integers(-5, top + 5, 300)])
        place = {v: i for i, v in enumerate(distinct.tolist())}
        assert EliasFano.of(distinct).find(ask).tolist() == [place.get(v, -1) for v in ask.tolist()]
    assert EliasFano.of(np.zeros(0, np.int64)).find(np.array([0, 3])).tolist() == [-1, -1]


# --- toxicity

def test_toxicity_finds_held_out_positives(spark):
    rng = random.Random(8)
    common = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]
    docs, labels = [], []
    for i in range(2000):
        body = [rng.choice(common) for _ in range(rng.randrange(10, 300))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                body.insert(rng.randrange(len(body)), rng.choice(["nastyword", "vilething", "dreckmann", "dreckfrau"]))
        docs.append((i, " ".join(body)))
        if rng.random() < 0.7:
            labels.append((i, int(toxic)))
    docs += [(5000, None), (5001, ""), (None, "wab nastyword vilething"), (5, docs[5][1])]
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(frame(spark, docs), marks, F.col("doc_id") % 3 != 1)
    out = toxicity.score_documents(frame(spark, docs), model)
    assert set(out.columns) == set(frame(spark).columns) | {"predicted"}
    got = out.collect()
    assert len(got) == len(docs)
    predicted = {r["doc_id"]: r["predicted"] for r in got}
    held = [(i, t) for i, t in labels if i % 3 == 1]
    caught = [predicted[i] for i, t in held if t]
    wrong = [predicted[i] for i, t in held if not t]
    assert sum(caught) >= 0.7 * len(caught) and sum(wrong) <= 0.03 * len(wrong)
    assert predicted[5000] == predicted[5001] == 0 and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.fit(frame(spark, docs), marks.filter("toxic = 0"), F.lit(True))
    assert {r["score"] for r in toxicity.score_documents(frame(spark, docs), empty).collect()} == {0.0}
    assert toxicity.score_documents(frame(spark, []), model).count() == 0


def test_negative_part_of_the_risk_is_corrected():
    rng = np.random.default_rng(1)
    held = rng.random((400, 40)) < 0.1
    toxic = np.arange(400) < 100
    held[toxic, 0] = rng.random(100) < 0.9
    held[~toxic, 0] = rng.random(300) < 0.15
    model = toxicity.train(toxic, held, [f"f{i}" for i in range(40)], 0.2)
    assert model.weight["f0"] > max(v for k, v in model.weight.items() if k != "f0")
    assert model.score({"f0"}) > 0.5 > model.score(set())


# --- byte-level BPE

def _reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_reference_and_round_trips(spark):
    other = _reference()
    rows = texts() + [(200, "É!! ÈAIVI!! " * 40), (201, "a" * 5000), (202, " " * 3000 + "x"), (203, "日本語🎉🎉 \x1c y​")]
    df = frame(spark, rows)
    out = encode_documents(df, RANKS, public_tokenizers.PATTERN, ids=True, digests=True)
    expected = []
    for i, t in rows:
        ids = other.encode_ordinary(t or "")
        expected.append((i, len(ids), ids, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_row((r[0], r[1], list(r[2]), r[3], r[4]) for r in out.collect()) == by_row(expected)
    back = decode_documents(out, RANKS)
    assert by_row((r[0], bytes(r[1])) for r in back.collect()) == by_row((i, (t or "").encode()) for i, t in rows)
    assert encode_documents(frame(spark, []), RANKS, public_tokenizers.PATTERN).count() == 0


def test_bpe_random_texts():
    other, own, rng = _reference(), Vocabulary.load(RANKS), random.Random(6)
    for _ in range(300):
        t = "".join(rng.choice("abc é漢🎉\n 's12!?\x1ceee") for _ in range(rng.randrange(1, 200)))
        assert encode_text(t, own, public_tokenizers.PATTERN) == other.encode_ordinary(t)


# --- personal data

def _luhn(digits):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(digits))) % 10 == 0


def _base(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 16 <= len(d) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


PRIVATE = [
    "a.b@c.de_x@y.org.. é🎉 me@host q@r.s-t.uv%z@w.com @x.y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 12.34.56.78.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 or 41111111111111112222", "+1 (555) 123-4567 +49.30.1234567 +1(((( +123 12-34",
    "漢字 +81 3 1234 5678é x@y.z 9807915762804490", "+1+2+33 4444 555 6666 77 88 99", "1" * 3000, "a" * 4000 + "@b.c", "." * 500 + "@" * 300,
    "10.0.0.1" * 50, "call 555 010 4477 or mail bob [at] site [dot] com", "+" * 200 + "1" * 15,
]


def test_personal_data_base_equals_brute_force(spark):
    rng = random.Random(9)
    rows = texts() + [(300 + i, t) for i, t in enumerate(PRIVATE)]
    rows += [(400 + i, "".join(rng.choice("a1 .@+-()5é4") for _ in range(rng.randrange(400)))) for i in range(60)]
    out = pii.find_personal_data(frame(spark, rows))
    got = out.select("doc_id", pii.listed("base").alias("base"), pii.listed("spans").alias("spans"), pii.redacted("text", "spans").alias("clean")).collect()
    expected = [(i, ",".join(f"{k}:{a}:{b}" for k, a, b in _base(t or ""))) for i, t in rows]
    assert by_row((r["doc_id"], r["base"]) for r in got) == by_row(expected)
    for r in got:
        assert set(r["base"].split(",")) - {""} <= set(r["spans"].split(","))
        if not r["spans"]:
            assert "<" not in r["clean"]
    assert pii.find_personal_data(frame(spark, [])).count() == 0


def test_boosted_candidates_add_what_looks_alike(spark):
    """Phones lose their plus sign in a twentieth of texts; the trees learn the shape and add those."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        phone = f"({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}"
        number = " ".join(str(rng.randrange(1, 9)) for _ in range(rng.randrange(8, 12)))
        rows.append((i, f"please call {'' if i % 40 == 0 else '+1 '}{phone} today or count {number} sheep"))
    out = pii.find_personal_data(frame(spark, rows), pii.Settings(sample_docs=900))
    got = {r["doc_id"]: r["spans"] for r in out.collect()}
    bare = [any(s["kind"] == 3 for s in got[i]) for i in range(0, 900, 40)]
    assert sum(bare) >= 0.8 * len(bare)
    sheep = sum(len(got[i]) > 1 for i in range(900))
    assert sheep <= 45


# --- LM scoring: the whole model

def test_lm_keeps_every_ngram_at_any_share(spark, monkeypatch):
    """Scores equal the plain model over all n-grams, singletons too, whatever the shard size and share."""
    from pricelake.llm import ngram_trie

    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.randrange(0, 40)))) for i in range(120)]
    rows += [(200, None), (None, "a b c"), (5, rows[5][1]), (300, "unseen words a b"), (301, "a unseen b"), (302, "a a a a a a a")]
    learn = [i is not None and i < 300 and i % 5 != 1 for i, _ in rows]
    split = [[*tokens(t), b"\n"] for _, t in rows]
    one, two, three = Counter(), Counter(), Counter()
    for w in (w for w, use in zip(split, learn, strict=True) if use):
        v = [b"\n", *w]
        one.update(w)
        two.update(zip(v, v[1:]))
        three.update(zip(v, v[1:], v[2:]))
    after = {x: sum(n - 0.75 for k, n in two.items() if k[0] == x) for x in one}
    after2 = {x: sum(n - 0.75 for k, n in three.items() if k[:2] == x) for x in two}
    bottom = sum(one.values()) + 0.5 * (len(one) + 1)

    def plain(c):
        return (one[c] + 0.5) / bottom

    def mixed(n, context, left, lower):
        return max(n - 0.75, 0) / context + max(1 - left / context, 1e-6) * lower if context else lower

    expected = []
    for w in split:
        v, total = [b"\n", *w], 0.0
        for p in range(1, len(v)):
            q = mixed(two[v[p - 1], v[p]], one[v[p - 1]], after.get(v[p - 1], 0), plain(v[p]))
            if p > 1:
                ab = (v[p - 2], v[p - 1])
                q = mixed(three[*ab, v[p]], two[ab], after2.get(ab, 0), q)
            total += math.log10(q)
        expected.append(total)
    order = sorted(range(len(rows)), key=lambda i: (str(rows[i][0]), expected[i]))
    for size, share in ((1_000_000, 0.5), (200, 1e-6)):
        monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", size, raising=False)
        fold = F.coalesce((F.col("doc_id") < 300) & (F.col("doc_id") % 5 != 1), F.lit(False))
        got = sorted(((str(r["doc_id"]), r["score"]) for r in score_documents(frame(spark, rows), fold, share=share).collect()))
        assert [i for i, _ in got] == [str(rows[i][0]) for i in order]
        for (_, score), i in zip(got, order, strict=True):
            assert abs(score - expected[i]) < 2 * len(split[i]) / 4096


# --- personal data: pre-filters, calibration

def test_candidate_prefilters_hold_in_every_match(spark):
    """Each kind's pre-filter passes every text in which its generator matches, however the parts are written."""
    rng = random.Random(21)
    alone = {"email": ["bob [at] site [dot] com", "x{at}y", "a@b", "me(at)z(dot)org"],
             "ip": ["server 192[.]168[.]0[.]1 answers", "server 10(.)0(.)0(.)1 answers", "1.2[.]3(.)4", "at 8.8.8.8"],
             "card": ["4111.1111.1111.1111", "4-1-1-1-1-1-1-1-1-1-1-1"], "phone": ["(555) 010-4477", "5(.1)-2..3 4 5 6 7"]}
    for kind, parts in (("email", ["a", "@", " [at] ", "(at)", ".", " {dot} ", "b"]), ("ip", ["1", "25", ".", "[.]", "(.)", "x"]),
                        ("card", ["1", "22", " ", ".", "-"]), ("phone", ["1", "22", " ", "(", ")", ".", "-", "+"])):
        rows = [(i, t) for i, t in enumerate(alone[kind] + ["".join(rng.choices(parts, k=rng.randrange(3, 24))) for _ in range(500)])]
        df = spark.createDataFrame(rows, "id long, text string")
        out = df.select("id", pii.find_spans("text", pii.GENERATORS[kind]).alias("plain"),
                        pii.find_spans("text", pii.GENERATORS[kind], pii.NEEDS[kind]).alias("found")).collect()
        assert all(r["plain"] == r["found"] for r in out)
        assert all(r["plain"] for r in out if r["id"] < len(alone[kind]))


def test_thresholds_come_from_all_documents(spark):
    """A kind that is rare in the sample is calibrated on the whole corpus."""
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        number = " ".join(str(rng.randrange(1, 9)) for _ in range(rng.randrange(8, 12)))
        rows.append((i, f"please call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} today or count {number} sheep"))
        if i % 10 == 0:
            rows.append((5000 + i, "the server 10." + ".".join(str(rng.randrange(100, 250)) for _ in range(3)) + " answers"))
    rows += [(9000 + i, f"the server 10[.]{i + 120}[.]133[.]201 answers") for i in range(3)]
    df = frame(spark, rows)
    slim = df.select(F.col("doc_id").alias("__id"), F.coalesce("text", F.lit("")).alias("__text"))
    settings = pii.Settings(sample_docs=200)
    assert "ip" in pii.train(slim, settings)[1]
    got = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(df, settings).collect()}
    assert all(any(s["kind"] == 1 for s in got[9000 + i]) for i in range(3))


def test_quality_phrase_in_a_long_line_costs_its_sentence(spark):
    rng = random.Random(7)
    body = [" ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(11)) + "." for _ in range(12)]
    phrase = "The mill was powered by water from the river and stood there until the year of the flood."
    rows = [(1, " ".join([*body[:6], phrase, *body[6:]])), (2, " ".join(body) + "\nPowered by Mill."), (3, " ".join(body))]
    out = {r["doc_id"]: r for r in assess(frame(spark, rows)).collect()}
    assert all(r["kept"] and r["text"] == " ".join(body) for r in out.values())
    assert [out[i]["n_failed_lines"] for i in (1, 2, 3)] == [0, 1, 0]


def test_quality_counts_characters_with_plain_searches(spark):
    """Odd blanks, symbols and letters count as before; no character map and no pattern of all phrases (slow on every character)."""
    from pricelake.llm import quality

    texts = ["", "a b #*$\t%&|<>x\n \n \t\n", "\U0001d400ǅ ALL CAPS HERE NOW.", "Fine line here. TERMS Of Use.\nIt goes on? Yes."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = quality.assess(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" not in plan and "RLIKE " + "|".join(quality.BOILERPLATE)[:20] not in plan
    found = {r.doc_id: r for r in out.collect()}
    blanks = set(" \t\n\x0b\f\r")
    for i, text in enumerate(texts):
        assert found[i].word_chars == sum(c not in blanks for c in text)
        assert found[i].n_symbols == sum(c in quality.SYMBOLS for c in text)
    assert found[3].text == "It goes on? Yes."


# --- LM scoring: packed n-grams

def test_packed_ngrams_take_few_bytes_and_round_trip():
    """Blocks of n-grams give back their words and numbers, also rare words and empty columns, in a third of their plain bytes."""
    from pricelake.llm.ngram_trie import packed, unpacked

    rng = np.random.default_rng(9)
    keys = np.sort(np.concatenate([-rng.integers(1, 1 << 62, 500), np.arange(30_000)]))
    rank = np.minimum(rng.zipf(1.2, (3, 50_000)), 30_000) - 1
    places = [np.where(rng.random(50_000) < 0.02, rng.integers(0, 500, 50_000), 500 + r) for r in rank]
    places[0].sort()
    row = (7 << 33) + rng.integers(0, 2000, 50_000)
    data = packed(keys, places, [row])
    words, numbers = unpacked(data)
    assert all((w == keys[p]).all() for w, p in zip(words, places, strict=True)) and (numbers[0] == row).all()
    assert len(data) < 4 * 8 * 50_000 / 3
    none = np.zeros(0, np.int64)
    words, numbers = unpacked(packed(none, [none, none], [none]))
    assert [len(x) for x in words + numbers] == [0, 0, 0]


def test_added_up_counts_rows_also_beyond_one_number():
    from pricelake.llm.ngram_trie import added_up

    rng = np.random.default_rng(10)
    columns = [rng.integers(0, 6, 1000) for _ in range(3)]
    n = rng.integers(1, 5, 1000)
    expected = Counter()
    for *row, k in zip(*columns, n, strict=True):
        expected[tuple(map(int, row))] += int(k)
    for top in (6, 1 << 40):  # as one number, and by columns
        got, sums = added_up(columns, top, n)
        assert list(zip(zip(*(x.tolist() for x in got), strict=True), sums.tolist(), strict=True)) == sorted(expected.items())
        assert added_up(columns, top)[1].sum() == 1000


def test_elias_fano_finds_among_many_with_the_same_high_bits():
    """One bucket of very many numbers takes as many steps as its halves, not as its numbers."""
    values = np.concatenate([np.arange(200_000), [1 << 50]])
    coded = EliasFano.of(values)
    steps = []
    low_part = coded.low_part
    coded.low_part = lambda at: steps.append(len(at)) or low_part(at)
    ask = np.array([0, 5, 199_999, 200_000, 1 << 50, (1 << 50) + 1, -3])
    assert coded.find(ask).tolist() == [0, 5, 199_999, -1, 200_000, -1, -1]
    assert len(steps) < 40
    assert (coded.every() == values).all()


def test_lm_words_with_several_shards_may_be_rare(spark, monkeypatch):
    """A word dealt to several shards need not be among the words sent to every task: its hash stays exact."""
    from pricelake.llm import ngram_trie

    rng = random.Random(14)
    rows = [(i, " ".join(rng.choice("aaabcd") * rng.randrange(1, 3) for _ in range(30))) for i in range(80)]
    got = []
    for size, share in ((1_000_000, 1e-6), (200, 0.5)):
        monkeypatch.setattr(ngram_trie, "SHARD_TOKENS", size)
        got.append(sorted((r["doc_id"], r["score"]) for r in score_documents(frame(spark, rows), F.col("doc_id") % 5 != 1, share=share).collect()))
    assert all(i == j and abs(x - y) < 1e-6 for (i, x), (j, y) in zip(*got, strict=True))


# --- LM scoring: blocks

def test_lm_words_of_texts_are_their_tokens():
    """Words found column by column are those of each text: white space is that of ASCII only, A-Z alone is lower-cased."""
    import pyarrow as pa

    from pricelake.llm.ngram_trie import words_of

    rows = [None, "", "  ", " A  b\tC\n", "x\x0by\x0cz\rÄ É", "a\x1cb\x1fc\x00d", "a\u0085b c d", "İI퟿", *(t for _, t in texts())]
    words, size = words_of(pa.array(rows, pa.string()))
    ends = np.cumsum(size)
    got = [[w.encode() for w in words[int(e - n): int(e)].to_pylist()] for n, e in zip(size, ends, strict=True)]
    assert got == [tokens(t) for t in rows]


def test_lm_block_sends_each_distinct_trigram_once(tmp_path):
    """Copies cost a block no more trigrams; counts are those of learned texts, and each token finds its trigram again."""
    import pyarrow as pa

    from pricelake.llm.ngram_trie import _Asked, _Block, _Texts, packed, unpacked

    some = [t for _, t in texts() if t][:6] * 40
    learn = [i % 3 != 1 for i in range(len(some))]
    held = _Texts()
    held.add(pa.array(range(len(some))), pa.array(some, pa.string()), pa.array(learn))
    (tmp_path / "1").write_bytes(held.file())
    words = _Block(str(tmp_path), 1).words.to_pylist()
    keys = np.where(np.arange(len(words)) % 2 == 1, ~np.arange(len(words)), np.arange(len(words)))  # every other word is rare
    stored = np.where(keys < 0, ~keys << 1 | 1, keys << 1)
    (tmp_path / "1-counts").write_bytes(packed(np.zeros(0, np.int64), [], [np.arange(len(words)) + 5, stored]))
    asked = _Asked(_Block(str(tmp_path), 1, counts=True), {int(keys[1]): 3}, 5)
    name = {int(k): w for k, w in zip(keys, words, strict=True)}
    expected, order = Counter(), []
    for text, use in zip(some, learn, strict=True):
        v = [b"\n", b"\n", *tokens(text), b"\n"]
        for a, b, c in zip(v, v[1:], v[2:]):
            expected[b, a, c] += use
            order.append((b, a, c))
    got, rare = Counter(), {}
    for _, grams, counts in asked.rows():
        columns, (n,) = unpacked(grams)
        for *gram, k in zip(*(x.tolist() for x in columns), n.tolist(), strict=True):
            assert tuple(name[g] for g in gram) not in got
            got[tuple(name[g] for g in gram)] = k
        seldom = sorted({k for x in columns for k in x.tolist() if k < 0})
        rare |= dict(zip(seldom, unpacked(counts)[1][0].tolist(), strict=True))
    assert got == expected and len(got) < len(order) / 20
    assert all(n == ~k + 5 for k, n in rare.items())
    b, a, c = ([name[int(asked.keys[i])] for i in x[asked.place]] for x in asked.columns)
    assert list(zip(b, a, c, strict=True)) == order
