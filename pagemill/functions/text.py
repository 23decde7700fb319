"""Column functions on texts: answer normalisation, token overlap, identifiers."""

from __future__ import annotations

from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

# Words dropped when answers are compared, words that say nothing about an answer's content, and phrases of
# an answer that claims its context to be missing.
ARTICLES = "a|an|the"
STOP = """a an the is are was were be been being have has had do does did will would could should may might shall can need
dare ought used to of in for on with at by from as into through during before after above below between out off over under
again further then once here there when where why how all each every both few more most other some such no not only own
same so than too very just because but and or if while about up it its that this these those what which who whom""".split()
NO_CONTEXT = ["does not contain", "do not contain", "no information", "not enough information", "cannot be determined", "not mentioned", "not provided", "context does not", "unable to find", "no relevant"]
PUNCTUATION = r"!-/:-@\[-`{-~"
BLANKS = r"[\s\p{Z}]+"


def without_thinking(c: Column) -> Column:
    """Without the reasoning between think tags; an open tag reaches to the end."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?s)<think>.*?</think>", ""), r"(?s)<think>.*", ""))


def normalise_numbers(c: Column) -> Column:
    """Thousands without commas, decimals without zeros at the end."""
    x = F.regexp_replace(c, ",([0-9]{3})", "$1")
    x = F.regexp_replace(x, r"([0-9]+\.[0-9]*[1-9])0*", "$1")
    return F.regexp_replace(x, r"([0-9]+)\.0+([^0-9]|$)", "$1$2")


def normalise_answer(c: Column) -> Column:
    """Lower case, articles dropped, ASCII punctuation deleted but between digits' decimals, single blanks."""
    x = F.regexp_replace(F.lower(c), rf"(?<![\p{{L}}\p{{N}}_])({ARTICLES})(?![\p{{L}}\p{{N}}_])", " ")
    x = F.regexp_replace(x, r"([0-9])\.([0-9])", "$1\u0001$2")
    x = F.translate(F.regexp_replace(x, f"[{PUNCTUATION}]", ""), "\u0001", ".")
    return F.trim(F.regexp_replace(x, BLANKS, " "))


def comparable(c: Column) -> Column:
    return normalise_answer(normalise_numbers(c))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda x: x != "")


def content_words(c: Column) -> Column:
    """The words of a text that aren't stop words, repeated ones too."""
    return F.filter(tokens(comparable(c)), lambda x: ~x.isin(STOP))


@F.pandas_udf(IntegerType())
def overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the multiset intersection of the words of two normalised texts; linear in their lengths."""
    return pd.Series([sum((Counter(x.split()) & Counter(y.split())).values()) if x is not None and y is not None else 0 for x, y in zip(a, b)], dtype="int32")


def token_scores(candidate: Column, reference: Column) -> Column:
    """(exact_match, f1, precision, recall) over token multisets, four places; both empty 1, one empty 0. A null text counts
    as empty."""
    cand, ref = comparable(without_thinking(F.coalesce(candidate, F.lit("")))), comparable(F.coalesce(reference, F.lit("")))
    n, nc, nr = overlap(cand, ref), F.size(tokens(cand)), F.size(tokens(ref))
    p, r = n / nc, n / nr
    score = lambda x: F.when((nc == 0) & (nr == 0), 1.0).when((nc == 0) | (nr == 0) | (n == 0), 0.0).otherwise(F.round(x, 4))
    return F.struct((cand == ref).alias("exact_match"), score(2 * p * r / (p + r)).alias("f1"), score(p).alias("precision"), score(r).alias("recall"))


def answer_in_context(reference: Column, context: Column, share: float = 0.5) -> Column:
    """Whether that share of the reference's content words, each occurrence counted, is in the context; true if it has none.
    Each text is normalised once: a lambda over its words would do it again for every word."""

    @F.pandas_udf(BooleanType())
    def enough(words: pd.Series, there: pd.Series) -> pd.Series:
        def one(x: str, y: str | None) -> bool:
            own, met = [w for w in x.split(" ") if w], set((y or "").split(" "))
            return not own or sum(w in met for w in own) / len(own) >= share

        return pd.Series([None if x is None else one(x, y) for x, y in zip(words, there)], dtype="object")

    return enough(F.array_join(content_words(reference), " "), comparable(context))


def refused(candidate: Column) -> Column:
    """Whether an answer claims its context to be missing."""
    return F.coalesce(candidate, F.lit("")).rlike("(?i)" + "|".join(NO_CONTEXT))


def by_context(score: Column, error: Column, candidate: Column) -> Column:
    """Whether an answer's failure mode depends on its words being in the context."""
    return ~error.eqNullSafe("thinking_truncated") & (score < 0.75) & ((score < 0.25) | refused(candidate))


def failure_mode(in_context: Column, score: Column, error: Column, candidate: Column) -> Column:
    """What went wrong with an answer, by the judge's score in bands of a quarter and three quarters."""
    return (
        F.when(error == "thinking_truncated", "thinking_truncated")
        .when(score.isNull(), "judge_error")
        .when(score >= 0.75, "correct")
        .when(refused(candidate), F.when(in_context, "refused_with_context").otherwise("refused_missing_context"))
        .when(score >= 0.25, "partial")
        .otherwise(F.when(in_context, "generation_miss").otherwise("retrieval_miss"))
    )


def path_stem(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"([^/\\]*)$", 1), r"\.[^.]*$", "")


def escape_like(s: str) -> str:
    return s.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_").replace("'", "''")


def metadata_predicate(labels: list[str], database: str | None = None) -> str:
    """LIKE predicate over JSON text: any of the labels, and the database."""
    like = lambda k, v: f"metadata LIKE '%\"{k}\":\"{escape_like(v)}\"%' ESCAPE '\\\\'"
    parts = ["(" + " OR ".join(like("label", x) for x in labels) + ")"] if labels else []
    return " AND ".join(parts + ([like("database", database)] if database else [])) or "true"
