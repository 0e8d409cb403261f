"""Line-first quality cleaning with DataFrame functions only.

Each line is judged by itself (punctuation, navigation, boilerplate), failing
lines are removed. A boilerplate phrase fails a line that it makes up a fair share of; of a longer line
only the sentences with a phrase are removed. Then a document that loses too much of its text is
rejected. Document-wide base counts stand beside it. There is no shuffle: a row's verdict needs that
row alone.

Defined results: a null or empty text has no words, so it fails the base rule;
repeated rows repeat; ids may be null. Blank lines fail no rule and count
as no text. Equality of 3-word windows is judged on 64-bit hashes of their words, within one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks between words.
BLANK = r"[\x20\x09-\x0D]+"
#: Symbols that are counted.
SYMBOLS = "#*$%&|<>"
#: Phrases of boilerplate lines.
BOILERPLATE = (
    "all rights reserved", "licensed under the", "permission is hereby granted", "without warranties or conditions",
    "terms of use", "terms of service", "terms and conditions", "privacy policy", "cookie policy", "use cookies",
    "enable javascript", "sign in to", "log in to", "subscribe to our", "click here", "read more", "skip to content",
    "lorem ipsum", "powered by", "back to top",
)


@dataclass(frozen=True)
class Rules:
    """Thresholds of the line rules and of the verdict."""

    min_words: int = 50
    max_repeat_share: float = 0.5
    #: What ends a sentence, closing quotes and brackets aside.
    sentence_end: str = r"[.!?…。！？:;][\"'”’»)\]]*(?=$|\s)"
    #: A line that doesn't end a sentence must have so many sentence ends inside.
    min_sentences: int = 2
    #: Symbols and separators a word at most.
    max_symbols_per_word: float = 0.3
    #: Repeated exclamation or question marks a word at most.
    max_shouts_per_word: float = 0.3
    #: Share of capital letters at most, for lines of more than three words.
    max_capitals: float = 0.7
    #: Share of a line's words in boilerplate phrases from which the whole line fails.
    min_phrase_share: float = 0.125
    #: Share of its characters that a document may lose.
    max_lost: float = 0.5


def _count_of(text: Column, chars: str) -> Column:
    """Number of characters of ``text`` that are among ``chars`` (none of them special in a class)."""
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _shape_fails(line: Column, rules: Rules) -> Column:
    """Name of the first rule of shape that a trimmed line breaks; null if none."""
    words = F.size(F.split(line, BLANK))
    symbols = _count_of(line, SYMBOLS + "»•")
    shouts = F.regexp_count(line, F.lit(r"[!?]{2,}"))
    letters = F.length(line) - F.length(F.regexp_replace(line, r"\p{L}+", ""))  # a match a run, not a letter
    capitals = F.regexp_count(line, F.lit(r"\p{Lu}"))
    return (F.when(F.length(line) == 0, F.lit(None))
            .when(~line.rlike(rules.sentence_end.replace(r"(?=$|\s)", "$"))
                  & (F.regexp_count(line, F.lit(rules.sentence_end)) < rules.min_sentences), F.lit("punctuation"))
            .when(shouts > rules.max_shouts_per_word * words, F.lit("punctuation"))
            .when(symbols > rules.max_symbols_per_word * words, F.lit("navigation"))
            .when((words > 3) & (capitals > rules.max_capitals * letters), F.lit("navigation")))


def _has_phrase(text: Column) -> Column:
    """Plain searches: trying every phrase at every character takes a pattern much longer. The text is lower-cased once."""
    return F.exists(F.array(F.lower(text)), lambda low: reduce(or_, [low.contains(p) for p in BOILERPLATE]))


def kept_line(line: Column, rules: Rules = Rules()) -> Column:
    """What is left of a line: null if it breaks a rule (punctuation, navigation, boilerplate), a longer
    line without its boilerplate sentences (null if it has no other), else the line."""
    trimmed = F.trim(line)
    found = F.regexp_extract_all(F.lower(trimmed), F.lit("|".join(BOILERPLATE)), F.lit(0))
    phrase_words = F.size(F.split(F.array_join(found, " "), " "))
    # Sentences keep the blanks after them.
    sentences = F.split(line, r"""(?<=[.!?…。！？][\"'”’»)\]]{0,3}\s{1,9})(?=\S)""")
    rest = F.array_join(F.filter(sentences, lambda x: ~_has_phrase(x)), "")
    return (F.when(_shape_fails(trimmed, rules).isNotNull(), F.lit(None))
            .when(~_has_phrase(trimmed), line)
            .when(phrase_words >= rules.min_phrase_share * F.size(F.split(trimmed, BLANK)), F.lit(None))
            .when(F.length(F.trim(rest)) > 0, rest))


def assess(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, n_failed_lines, text).

    ``text`` is the cleaned text, what is left of its lines; ``n_failed_lines`` of them are gone as a whole. n_repeat_words: 3-word windows are
    sorted by hash with their places; the places of windows with an equal neighbour are put
    in order, and each adds the words up to the next one, three at most.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.select(F.col(id_col).alias("__id"), text.alias("__text"))
    step = step.withColumns({
        "__words": F.filter(F.split("__text", BLANK), lambda w: F.length(w) > 0),
        "__lines": F.split("__text", "\n"),
        "n_symbols": _count_of(F.col("__text"), SYMBOLS).cast("long"),
    })
    n = F.size("__words")
    step = step.withColumns({
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_words": n.cast("long"),
        "__hashes": F.when(n >= 4, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
            F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))),
        "__text_lines": F.filter("__lines", lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        "__good": F.filter(F.transform("__lines", lambda x: kept_line(x, rules)), lambda x: x.isNotNull()),
    })
    step = step.select(
        "__id", "n_words", "word_chars", "n_symbols", "__lines", "__good",
        (F.size("__text_lines") - F.size(F.array_distinct("__text_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""CASE WHEN size(array_distinct(__hashes)) < size(__hashes)
                  THEN sort_array(transform(__hashes, (h, i) -> struct(h, i))) END""").alias("__sorted"))
    step = step.withColumn("__places", F.expr("""sort_array(transform(filter(__sorted, (x, k) ->
        (k > 0 AND get(__sorted, k - 1).h = x.h) OR coalesce(get(__sorted, k + 1).h = x.h, false)), x -> x.i))"""))
    step = step.withColumn("n_repeat_words", F.coalesce(F.expr("""aggregate(transform(__places, (p, k) ->
        least(3, coalesce(get(__places, k + 1) - p, 3))), 0L, (a, x) -> a + x)"""), F.lit(0).cast("long")))
    step = step.withColumn("text", F.array_join("__good", "\n"))
    lost = F.col("word_chars") - F.length(F.array_join(F.split("text", BLANK), ""))
    step = step.withColumn("base_failed", (F.col("n_words") < rules.min_words)
                           | (F.col("n_repeat_words") > rules.max_repeat_share * F.col("n_words")))
    return step.select(
        F.col("__id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (lost <= rules.max_lost * F.col("word_chars"))).alias("kept"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size("__good")).cast("long").alias("n_failed_lines"), "text")
