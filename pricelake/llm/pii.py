"""Personal data: rule-based spans, and candidates judged by gradient-boosted trees.

Everything is DataFrame expressions and Spark ML's boosted trees; no Python
runs on rows. Two layers:

* base spans: four exact patterns (email, ip, card, phone), leftmost and
  non-overlapping per kind, with their checks (parts up to 255, Luhn, digit counts);
* candidates: per kind a generator of high recall proposes spans (obfuscated,
  partial and differently punctuated forms; spans of different kinds overlap).
  Boosted trees score a candidate from its format and its context. They learn on a
  bounded sample of documents, with the base spans as labels and without the features
  that the base checks decide on. Per kind the least score whose precision on held-out
  candidates reaches ``precision`` is the threshold; held out are all candidates of all documents
  that the trees have not learnt from, whatever the size. Accepted candidates that
  meet no base span of their kind are added.

The trees become one SQL expression, so scoring happens where the text is read: no shuffle of texts.

Defined results: a null or empty text has no spans; repeated rows repeat; ids
may be null; without candidates of both classes in the sample nothing is
added. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")

#: Base patterns. Runs are taken whole (possessive) and start at a run's start or where the last match
#: ended, which finds the same matches as the plain patterns without trying every place of a long run.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: what may be personal data, by shape.
GENERATORS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++(?:@|\x20?[\[({]at[\])}]\x20?)[A-Za-z0-9-]++"
             r"(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]++)*+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}+){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20.-]?[0-9]){11,18}+",
    "phone": r"(?:\G|(?<![0-9]))(?:\+|\()?[0-9](?:[\x20().-]{0,2}[0-9]){6,14}+",
}
#: What a text must hold to be searched for a kind at all; every match of a generator holds it.
NEEDS = {
    "email": r"@|[\[({]at[\])}]",
    "ip": r"[0-9](?:\.|\[\.\]|\(\.\))[0-9]",
    "card": r"[0-9](?:[\x20.-]?[0-9]){11}",
    "phone": r"[0-9](?:[\x20().-]{0,2}[0-9]){6}",
}
#: Words near personal data, as context features.
CONTEXT_WORDS = {
    "email": r"(?i)mail|contact|write|address",
    "ip": r"(?i)\bip\b|server|host|addr",
    "card": r"(?i)card|visa|master|credit|pay|account",
    "phone": r"(?i)tel|phone|call|fax|mobile|cell",
}
#: The plain form of a candidate x, whose shape the features describe: without country code or disguise.
PLAIN = {
    "email": r"""regexp_replace(regexp_replace(x.value, r'\x20?[\[({]at[\])}]\x20?', '@'), r'\x20?[\[({]dot[\])}]\x20?', '.')""",
    "ip": r"regexp_replace(x.value, r'[\[\]()]', '')",
    "card": "x.value",
    "phone": r"regexp_replace(x.value, r'^\+[0-9]{1,3}\x20?', '')",
}
FEATURES = ("kind", "length", "digits", "letters", "marks", "groups", "longest", "first_group", "last_group",
            "before_letter", "before_digit", "before_mark", "after_letter", "after_digit", "after_mark",
            "context_word", "context_digits")


@dataclass(frozen=True)
class Settings:
    """Bounds of the trees' sample, and what the thresholds aim at."""

    sample_docs: int = 4_000
    rounds: int = 8
    depth: int = 3
    precision: float = 0.95
    least_held_out: int = 20
    seed: int = 11


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def find_spans(text: str, pattern: str, needs: str | None = None) -> Column:
    """Leftmost non-overlapping matches in column ``text``: array of (start, end, value).

    A match begins where the gaps and matches before it end: gaps come from splitting at the same pattern.
    """
    p = _quoted(pattern)
    where = f"{text} RLIKE {_quoted(needs)}" if needs else "true"
    return F.expr(f"""CASE WHEN {where} THEN aggregate(
        arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0)),
        named_struct('at', 0, 'found', cast(array() AS array<struct<start:int,end:int,value:string>>)),
        (acc, x) -> named_struct('at', acc.at + length(x.`0`) + coalesce(length(x.`1`), 0),
            'found', CASE WHEN x.`1` IS NULL THEN acc.found ELSE concat(acc.found, array(struct(
                acc.at + length(x.`0`) AS start, acc.at + length(x.`0`) + length(x.`1`) AS end, x.`1` AS value))) END),
        acc -> acc.found) ELSE cast(array() AS array<struct<start:int,end:int,value:string>>) END""")


_DIGITS = "translate(x.value, ' -', '')"
#: The checks of base matches, on a match x.
CHECKS = {
    "email": "true",
    "ip": "forall(split(x.value, r'\\.'), p -> length(trim(LEADING '0' FROM p)) <= 3 AND cast(right(concat('000', p), 3) AS int) <= 255)",
    "card": f"""length({_DIGITS}) BETWEEN 16 AND 19 AND aggregate(sequence(1, length({_DIGITS})), 0, (s, i) -> s
        + CASE WHEN (length({_DIGITS}) - i) % 2 = 0 THEN cast(substr({_DIGITS}, i, 1) AS int)
               WHEN cast(substr({_DIGITS}, i, 1) AS int) > 4 THEN 2 * cast(substr({_DIGITS}, i, 1) AS int) - 9
               ELSE 2 * cast(substr({_DIGITS}, i, 1) AS int) END) % 10 = 0""",
    "phone": "regexp_count(x.value, '[0-9]') BETWEEN 8 AND 15",
}


def _features(kind: int, text: str) -> str:
    """The feature struct of a candidate x, as SQL."""
    before, after = f"substr({text}, greatest(x.start, 1), least(x.start, 1))", f"substr({text}, x.end + 1, 1)"
    near = f"concat(substr({text}, greatest(x.start - 23, 1), least(x.start, 24)), ' ', substr({text}, x.end + 1, 12))"
    values = {
        "kind": f"{kind}", "length": "length(x.plain)", "digits": "regexp_count(x.plain, '[0-9]')",
        "letters": "regexp_count(x.plain, '[A-Za-z]')", "marks": "regexp_count(x.plain, '[^A-Za-z0-9]')",
        "groups": "regexp_count(x.plain, '[0-9]+')",
        "longest": "array_max(transform(split(x.plain, '[^0-9]+'), g -> length(g)))",
        "first_group": "length(regexp_extract(x.plain, '^[^0-9]*([0-9]*)', 1))",
        "last_group": "length(regexp_extract(x.plain, '([0-9]*)[^0-9]*$', 1))",
        "before_letter": rf"cast({before} RLIKE r'\p{{L}}' AS int)", "before_digit": f"cast({before} RLIKE '[0-9]' AS int)",
        "before_mark": rf"cast({before} RLIKE r'[^\p{{L}}0-9\s+(]' AS int)",
        "after_letter": rf"cast({after} RLIKE r'\p{{L}}' AS int)", "after_digit": f"cast({after} RLIKE '[0-9]' AS int)",
        "after_mark": rf"cast({after} RLIKE r'[^\p{{L}}0-9\s.,]' AS int)",
        "context_word": f"cast({near} RLIKE {_quoted(CONTEXT_WORDS[KINDS[kind]])} AS int)",
        "context_digits": f"regexp_count({near}, '[0-9]')",
    }
    return ", ".join(f"'{name}', cast({values[name]} AS double)" for name in FEATURES)


def with_spans(docs: DataFrame, text_col: str = "__text") -> DataFrame:
    """``docs`` with, per kind, the base spans (``__base_<kind>``) and the candidates (``__cand_<kind>``).

    A candidate carries its features and ``known``: whether it meets a base span of its kind.
    """
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"__base_{kind}", find_spans(text_col, BASE[kind], NEEDS[kind] if kind != "phone" else r"\+[0-9]"))
        out = out.withColumn(f"__base_{kind}", F.expr(
            f"transform(filter(__base_{kind}, x -> {CHECKS[kind]}), x -> struct(x.start AS start, x.end AS end))"))
    for k, kind in enumerate(KINDS):
        out = out.withColumn(f"__cand_{kind}", find_spans(text_col, GENERATORS[kind], NEEDS[kind]))
        out = out.withColumn(f"__cand_{kind}", F.expr(
            f"transform(transform(__cand_{kind}, x -> struct(x.start AS start, x.end AS end, {PLAIN[kind]} AS plain)), x -> named_struct('start', x.start, 'end', x.end, "
            f"'known', exists(__base_{kind}, b -> b.start < x.end AND x.start < b.end), {_features(k, text_col)}))"))
    return out


def _tree_sql(node, name) -> str:
    """A trained tree as nested CASE expressions."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    return (f"CASE WHEN {name(split.featureIndex())} <= {float(split.threshold())!r} THEN {_tree_sql(node.leftChild(), name)} "
            f"ELSE {_tree_sql(node.rightChild(), name)} END")


def score_sql(model, candidate: str) -> str:
    """Probability that ``candidate`` (a struct of features) is personal data, as SQL."""
    name = lambda i: f"{candidate}.{FEATURES[i]}"
    trees = [f"{float(w)!r} * ({_tree_sql(t._java_obj.rootNode(), name)})" for w, t in zip(model.treeWeights, model.trees, strict=True)]
    return f"1 / (1 + exp(-2 * ({' + '.join(trees)})))"


def train(docs: DataFrame, settings: Settings = Settings()):
    """(model, {kind: threshold}) of documents (__id, __text); (None, {}) without both classes in the sample.

    The trees learn on a bounded sample; the thresholds come from all candidates they have not learnt from.
    """
    # Rows with a candidate, those of least hash; equal rows have one hash and count once in the sample.
    maybe = F.lit(False)
    for kind in KINDS:
        maybe = maybe | (F.col("__text").rlike(NEEDS[kind]) & F.col("__text").rlike(GENERATORS[kind]))
    order = F.xxhash64("__id", "__text", F.lit(settings.seed))
    last = docs.filter(maybe).select(order.alias("o")).orderBy("o").limit(settings.sample_docs).agg(F.max("o")).first()[0]
    if last is None:
        return None, {}
    chosen = docs.filter((order <= last) & maybe).dropDuplicates(["__id", "__text"])
    each = with_spans(chosen).select("__id", F.explode(F.concat(*[F.col(f"__cand_{k}") for k in KINDS])).alias("c"))
    each = stored(each.select("c.*", F.pmod(F.xxhash64("__id", "c.kind", "c.start"), F.lit(4)).alias("fold")), "pii-candidates")
    classes = each.filter("fold <> 0").agg(F.count_if(F.col("known")), F.count_if(~F.col("known"))).first()
    if not all(classes):
        return None, {}
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        each.withColumn("label", F.col("known").cast("double")))
    model = GBTClassifier(maxIter=settings.rounds, maxDepth=settings.depth, stepSize=0.3, maxBins=64, seed=settings.seed,
                          checkpointInterval=-1).fit(rows.filter("fold <> 0").select("features", "label").coalesce(1))
    # Held out are a quarter of the sample's candidates and those of all other documents, added up in tasks.
    held_out = each.filter("fold = 0").drop("fold")
    others = with_spans(docs.filter(order > last)).select(F.explode(F.concat(*[F.col(f"__cand_{k}") for k in KINDS])).alias("c"))
    held_out = held_out.unionByName(others.select("c.*"))
    # Their precision at each score, from the highest score down; scores are as few as the trees' leaf patterns.
    scored = (held_out.withColumn("score", F.expr(score_sql(model, "c").replace("c.", "")))
              .groupBy("kind", "score").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("known")).alias("good")).collect())
    thresholds = {}
    for k, kind in enumerate(KINDS):
        of_kind = sorted((r for r in scored if r["kind"] == k), key=lambda r: -r["score"])
        least = min(settings.least_held_out, sum(r["n"] for r in of_kind))
        n = good = 0
        for row in of_kind:
            n, good = n + row["n"], good + row["good"]
            if n >= least and good >= settings.precision * n:
                thresholds[kind] = row["score"]
    return model, thresholds


def find_personal_data(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, base, spans): arrays of (kind number, start, end) by kind and start; ``spans`` has the added ones too."""
    slim = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    model, thresholds = train(slim, settings)
    out = with_spans(slim)
    base = ", ".join(f"transform(__base_{kind}, x -> struct({k} AS kind, x.start AS start, x.end AS end))" for k, kind in enumerate(KINDS))
    added = ", ".join(
        f"transform(filter(__cand_{kind}, x -> NOT x.known AND {score_sql(model, 'x')} >= {thresholds[kind]!r}), "
        f"x -> struct({k} AS kind, x.start AS start, x.end AS end))" for k, kind in enumerate(KINDS) if kind in thresholds)
    out = out.withColumn("base", F.expr(f"concat({base})"))
    out = out.withColumn("spans", F.expr(f"array_sort(concat(base{', ' + added if added else ''}))"))
    return out.select(F.col("__id").alias(id_col), F.col("__text").alias(text_col), "base", "spans")


def listed(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', get(array({names}), x.kind), x.start, x.end)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with each span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    names = ", ".join(f"'<{k}>'" for k in KINDS)
    return F.expr(f"""aggregate(array_sort(transform({spans}, x -> struct(x.start AS start, x.end AS end, x.kind AS kind))),
        named_struct('at', 0, 'done', ''),
        (acc, x) -> CASE WHEN x.start < acc.at THEN acc ELSE named_struct('at', x.end,
            'done', concat(acc.done, substr({text}, acc.at + 1, x.start - acc.at), get(array({names}), x.kind))) END,
        acc -> concat(acc.done, substr({text}, acc.at + 1)))""")
