"""Small documents with every awkward case: nulls, empty and blank texts, ties, repeated rows, clashing columns, a long text."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.IntegerType()),
    # names that operators use for their own columns
    T.StructField("digest", T.StringType()), T.StructField("fp", T.IntegerType()), T.StructField("n_lines", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("row", T.IntegerType()),
])


def texts(seed: int = 5) -> list[tuple[int | None, str | None]]:
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "delta", "ÉTÉ", "été", "x1", "漢字", "of", "the", "and", "to", "q.", "r,", "zeta", "eta"]

    def make(n: int) -> str:
        out = []
        for i in range(n):
            out.append(rng.choice(words) + (str(rng.randrange(60)) if rng.random() < 0.5 else ""))
            out.append("\n" if rng.random() < 0.06 else rng.choice([" ", " ", "  ", "\t"]))
        return "".join(out)

    shared = " ".join(f"pass{i}" for i in range(70))
    bodies = [make(rng.randrange(5, 160)) for _ in range(24)]
    rows: list[tuple[int | None, str | None]] = [(i, b) for i, b in enumerate(bodies)]
    rows += [(30 + i, f"{make(20)} {shared} {make(20)}") for i in range(6)]
    rows += [(40 + i, bodies[3]) for i in range(3)]
    rows += [(50, bodies[4] + " end"), (51, bodies[4].replace("alpha", "beta", 1))]
    rows += [(60 + i, f"Common Line here.\n{make(8)}\n  common line HERE. \t") for i in range(12)]
    rows += [(80, None), (81, ""), (82, " \n\t\r\n "), (83, "one"), (84, "\n\n\n"), (85, "  \x1c é \x85")]
    rows += [(90, make(6000)), (91, "ab" * 900), (92, "word " * 400)]
    rows += [(100, bodies[7]), (100, bodies[7]), (101, bodies[8]), (101, "same id, other text " + make(30))]
    rows += [(None, bodies[9]), (None, None), (None, "null id " + make(25))]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "d", 1, "l", "s", "p", 2) for i, t in rows], SCHEMA).repartition(3)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_row(rows) -> list[tuple]:
    return sorted(rows, key=repr)
