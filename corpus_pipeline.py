"""The corpus pipeline: stages over ``documents``, each calling one operator of ``pricelake.llm``.

Each stage works on all rows that its predecessor kept, whole texts, and its
decisions take effect. Every stage but the last returns the columns of
``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.llm.bpe import encode_documents
from pricelake.llm.common import stored
from pricelake.llm.decontaminate import remove_contaminated
from pricelake.llm.line_dedup import dedup_lines
from pricelake.llm.simhash import keep_one
from pricelake.llm.toxicity import fit, score_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents (score 0.7 or more) go. The model learns outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = fit(docs, labels, learn)
    return score_documents(docs, model, threshold=0.7).filter("predicted = 0").select([F.col(f"`{c}`") for c in docs.columns])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least 10 documents hold go; the document stays, and ``n_chars`` follows its text."""
    out = dedup_lines(docs, min_docs=10).select([F.col(f"`{c}`") for c in docs.columns])
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays."""
    return keep_one(docs, shingle=3, radius=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): the token ids of each document, decoded again for the check."""
    import public_tokenizers

    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", encoding),
]

#: SQL expresses neither the trained classifier nor the merges; tests compare with brute force stage by stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored as Parquet and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
