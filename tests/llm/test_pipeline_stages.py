"""The corpus pipeline: each stage on its predecessor's rows, against brute force."""

import base64

import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from pricelake.llm.common import stored

from .messy import by_row, frame, texts
from .test_dedup import _fingerprint, _groups, _lines
from .test_text_models import RANKS, _hits


def _tables(spark, tmp):
    rows = texts()
    bad = [(1000 + i, f"some words {i} nastyword vilething here and there {i * 7}") for i in range(120)]
    fine = [(2000 + i, f"other words {i} kind things here and there {i * 5} " + "calm day " * (i % 4)) for i in range(240)]
    rows = rows + bad + fine
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp}/documents.parquet")
    labels = [(i, 1, 1) for i, _ in bad] + [(i, 1, 0) for i, _ in fine] + [(None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    items = [(1, " ".join(f"pass{i}" for i in range(12))), (2, "calm day calm day calm day")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    return rows, items


def test_stages(spark, tmp):
    rows, items = _tables(spark, tmp)
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "SimHash near-dedup"
    docs = spark.read.parquet(f"{tmp}/documents.parquet")
    columns, now = docs.columns, rows
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, tmp), f"test{k}")
        if k < 4:
            assert docs.columns == columns
            got = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if k == 0:
            gone = {i for i, _ in now} - {i for i, _ in got}
            assert gone <= set(range(1000, 1120)) and len(gone) >= 100, gone
            now = got
        elif k == 1:
            now = [(i, t) for i, _, _, t in _lines(now, 10)]
            assert by_row(got) == by_row(now)
        elif k == 2:
            group = _groups([_fingerprint(t) for _, t in now], 2)
            heads = {}
            for i, t in now:
                order = (i is None, i or 0)
                heads[group[_fingerprint(t)]] = min(heads.get(group[_fingerprint(t)], order), order)
            assert by_row(i for i, _ in got) == by_row(None if none else i for none, i in heads.values())
            assert len({group[_fingerprint(t)] for _, t in got}) == len(got)
            now = got
        elif k == 3:
            leaks = {(i, t) for i, t in now if any(n for _, _, n, _ in _hits([(i, t)], items, 10))}
            now = [x for x in now if x not in leaks]
            assert by_row(got) == by_row(now) and leaks
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(RANKS, "rb"))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert by_row((r["doc_id"], list(r["ids"])) for r in docs.collect()) == by_row((i, other.encode_ordinary(t or "")) for i, t in now)
    whole = corpus_pipeline.run(spark, tmp)
    assert whole.columns == docs.columns and whole.count() == docs.count()
    assert whole.agg(F.sum("n_tokens")).first() == docs.agg(F.sum("n_tokens")).first()


def test_registered_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
