"""Text statistics of documents, and how far each is from the prose of its language.

Each document has a vector of statistics. The prose of a language has a mean and a covariance over them, fitted robustly:
sums of products over all documents near the centre, twice trimmed by distance. The covariance of a document is that of its
language and the sampling error of its own length, so that a short text isn't far for its shortness. The squared
Mahalanobis distance is the sum of one contribution a statistic; a document far from prose is of the kind whose statistics
contribute most.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import kernels as K
from pagemill.runtime import prepare, staged, table

STATS = ["log_words", "mean_word", "symbols", "digits", "common", "ended", "table_part", "list_part", "variety", "longest_word", "vowels"]
D, SYMBOLS, COMMON = len(STATS), STATS.index("symbols"), STATS.index("common")
#: Squared distance beyond which a document is no ordinary prose: the 0.95 quantile of chi-squared with one degree a statistic.
FAR = 19.68
#: The statistics that tell each kind, and the 0.95 quantile of chi-squared with one degree for each of them.
GROUPS = {"list": (["list_part"], 3.84), "table": (["table_part"], 3.84), "junk": (["mean_word", "symbols", "common", "longest_word", "vowels"], 11.07)}
#: Contribution of fewer common words than prose has, from which a text is unreadable: the 0.9 quantile with one degree.
FEWER = 2.71
#: The part of symbols in a text's characters from which it is unreadable.
SYMBOLIC = 0.3
TRIM = 19.68  # the 0.95 quantile
ROUNDS = 3
#: The part of letters and digits in a line's characters that a list item and a table row have at least.
READABLE = {"list": 0.6, "table": 0.25}

_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_KANA = re.compile(r"[぀-ヿ㐀-鿿]+")
_MARK = re.compile(r"\s*(?:[-–—•*·▪◦‣]|\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+\S")
_VOWELS = ("aeiouyàáâãäåæèéêëìíîïòóôõöøùúûüýăơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹаеёиоуыэюя")
#: The script of a language; all others are written in Latin letters.
SCRIPTS = {"ru": "cyrillic", "ja": "kana"}
_ENDS = tuple(".!?。！？:;…")
_CYR = re.compile(r"[Ѐ-ӿ]")


def line_kinds(lines: list[str]) -> list[str]:
    """'table', 'list' or 'text' of each line, from its own marks and its neighbours'."""
    n = len(lines)
    kinds = ["text"] * n
    prev = ("", 0)
    for i, x in enumerate(lines):
        s = x.strip()
        if s.startswith("|") and s.count("|") > 1:
            kinds[i] = "table"
            continue
        for m in ("\t", ";", ","):
            c = x.rstrip("\r").count(m)
            if c and (m != "," or not re.search(r",\s", s)) and (m == "\t" or m == "," or " " not in s.replace("; ", ";") or c > 1):
                if prev == (m, c):
                    kinds[i] = kinds[i - 1] = "table"
                prev = (m, c)
                break
        else:
            c = len(re.findall(r"\S {2,}(?=\S)", s))
            if c:
                if prev[0] == "  ":
                    kinds[i] = kinds[i - 1] = "table"
                prev = ("  ", c)
            else:
                prev = ("", 0)
        if kinds[i] == "text" and _MARK.match(x):
            kinds[i] = "list"
    # rows and items hold letters or digits for a part
    for i, x in enumerate(lines):
        if kinds[i] != "text" and sum(map(str.isalnum, x)) < READABLE[kinds[i]] * len("".join(x.split())):
            kinds[i] = "text"
    # runs of short lines that begin with a capital letter and have no end mark; lines of one width are wrapped prose
    i = 0
    while i < n:
        j = i
        while j < n and kinds[j] == "text" and 0 < len(s := lines[j].strip()) < 75 and (s[0].isupper() or not s[0].isalpha() or ord(s[0]) > 0x3000) and not s.endswith(_ENDS) and sum(map(str.isalnum, s)) >= READABLE["list"] * len("".join(s.split())):
            j += 1
        if j - i >= 3:
            w = [len(lines[k].strip()) for k in range(i, j)]
            inner = sorted(w[:-1])
            if not (inner[len(inner) // 4] > 0.8 * inner[-1] and inner[-1] > 45 and sum(len(_WORD.findall(lines[k])) for k in range(i, j)) > 7 * (j - i)):
                kinds[i:j] = ["list"] * (j - i)
        i = max(j, i + 1)
    return kinds


def measure(text: str, common: dict[str, frozenset], letters: int, vowels: int, solid: int, symbols: int, digits: int) -> tuple[str, list[float], list[float]]:
    """The language by common words, or '' and the script, the statistics, and the parts of characters that are list and
    table. letters to digits: numbers of such characters in the text."""
    words = _WORD.findall(text.lower())
    n_kana = sum(map(len, _KANA.findall(text)))
    n_letters = sum(map(len, words)) or 1
    language, share = "", 0.0
    if n_kana * 3 > n_letters:
        particles = sum(text.count(p) for p in "はのをにがでと")
        language, share = "ja", min(1.0, particles * 4 / max(1, n_kana))
    else:
        for lang, known in common.items():
            if lang != "ja":
                s = sum(w in known for w in words) / max(1, len(words))
                if s > share:
                    language, share = lang, s
        language = language or (":cyrillic" if 2 * len(_CYR.findall(text)) > letters else ":latin")
    lines = [x for x in text.split("\n") if x.strip()]
    kinds = line_kinds(lines)
    total = sum(len(x.strip()) for x in lines) or 1
    part = {k: sum(len(x.strip()) for x, y in zip(lines, kinds) if y == k) / total for k in ("list", "table")}
    ended = sum(x.rstrip().endswith(_ENDS) for x in lines) / max(1, len(lines))
    ja = language == "ja"
    running = [x for x, k in zip(lines, kinds) if k == "text"] or lines
    longest = 10 if ja else max((len(t) for x in running for t in x.split()), default=0)
    variety = 1.0 if ja else np.log1p(len(set(words))) / np.log1p(max(1, len(words)))
    mean = 5.0 if ja else n_letters / max(1, len(words))
    open_ = 0.4 if ja else vowels / max(1, letters)
    solid = max(1, solid)
    return language, [float(np.log1p(n_kana / 4 if ja else len(words))), mean, symbols / solid, digits / solid, share, ended, part["table"], part["list"], float(variety), float(np.log1p(longest)), open_], [part["list"], part["table"], float(solid)]


STATISTICS = "id bigint, language string, x array<double>, list_part double, table_part double, solid double"


def statistics(docs: DataFrame, common: dict[str, frozenset]) -> DataFrame:
    """(id, language, x, list_part, table_part, solid) of the texts; null and blank texts are left out. language is '' and
    a script where no common word tells it; solid is the number of characters that aren't blank."""
    prepare(docs.sparkSession)

    def of(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            filled = [i for i, t in enumerate(texts) if not t.isspace()]
            batch, texts = batch.take(pa.array(filled, pa.int64())), [texts[i] for i in filled]
            a, sep = K.code_points(texts)
            letters, vowels, alnum, digits, space = (K.counts(a, sep, k) for k in ("alpha", _VOWELS, "alnum", "digit", "space"))
            solid = np.diff(np.r_[-1, sep]) - 1 - space
            rows = [measure(t, common, *v) for t, v in zip(texts, np.stack([letters, vowels, solid, solid - alnum, digits], axis=1).tolist())]
            x = np.array([r[1] for r in rows], np.float64).reshape(-1, D)
            off = np.arange(0, (len(rows) + 1) * D, D, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.ListArray.from_arrays(pa.array(off), pa.array(x.ravel())), *[pa.array([r[2][k] for r in rows], pa.float64()) for k in range(3)]],
                names=["id", "language", "x", "list_part", "table_part", "solid"],
            )

    return docs.select("id", "text").where("id is not null and rlike(text, '\\\\S')").mapInArrow(of, STATISTICS)


def contributions(x: np.ndarray, solid: np.ndarray, mu: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """The parts (n x D) of the squared distances of x from the prose with that mean and covariance."""
    words = np.maximum(np.expm1(x[:, 0]), 1.0)
    letters = np.maximum(words * x[:, 1], 1.0)
    share = lambda name, of, each=1.0: each * max(mu[STATS.index(name)] * (1 - mu[STATS.index(name)]), 0.01) / of
    # sampling variances: a share's by the number it is of (symbols and digits come in groups), a mean's by that of its terms
    error = {"mean_word": 8.0 / words, "symbols": share("symbols", np.maximum(solid, 1.0), 3.0), "digits": share("digits", np.maximum(solid, 1.0), 4.0), "common": share("common", np.maximum(words, letters / mu[1])), "longest_word": 0.5 / words, "vowels": share("vowels", letters)}
    own = np.zeros_like(x)
    for name, v in error.items():
        own[:, STATS.index(name)] = v
    d = x - mu
    return d * np.linalg.solve(cov[None] + own[:, :, None] * np.eye(D)[None], d[:, :, None])[:, :, 0]


def fit(stats: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Mean and covariance of the prose of each language. What reaches the driver are sums of products, one bounded row a
    language. Starts from lines that are neither list nor table and known words, then trims by distance."""
    model: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    for _ in range(ROUNDS):

        def sums(batches, model=dict(model)):
            acc: dict[str, np.ndarray] = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
                lang, solid = np.array(batch.column(0).to_pylist(), dtype=object), batch.column(2).to_numpy()
                for name in set(lang):
                    y, size = x[lang == name], solid[lang == name]
                    if model.get(name) is not None:
                        y = y[contributions(y, size, *model[name]).sum(axis=1) <= TRIM]
                    else:
                        y = y[(y[:, 4] > 0.12) & (y[:, 6] < 0.2) & (y[:, 7] < 0.2)]
                    z = np.c_[np.ones(len(y)), y]
                    acc[name] = acc.get(name, 0) + z.T @ z
            for name, m in acc.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * m.size), pa.array(np.arange(m.size)), pa.array(m.ravel())], names=["language", "i", "v"])

        rows = stats.select("language", "x", "solid").where("language not like ':%'").mapInArrow(sums, "language string, i bigint, v double").groupBy("language", "i").agg(F.sum("v").alias("v")).collect()
        by: dict[str, np.ndarray] = {}
        for r in rows:
            by.setdefault(r["language"], np.zeros((D + 1) ** 2))[r["i"]] = r["v"]
        for name, flat in by.items():
            m = flat.reshape(D + 1, D + 1)
            if (n := m[0, 0]) > 3 * D:
                mu = m[0, 1:] / n
                cov = m[1:, 1:] / n - np.outer(mu, mu)
                # a statistic that hardly varies in prose still may by a fortieth
                model[name] = (mu, cov + np.diag(np.maximum(1e-9, (0.025 - np.sqrt(np.maximum(np.diag(cov), 0))).clip(0) ** 2 + 1e-6)))
    return model


def outliers(docs: DataFrame, common: dict[str, frozenset]) -> DataFrame:
    """(id, language, distance, contributions, kind): squared distance to the prose of the document's language, each
    statistic's part in it, and what the document is if it isn't prose: list, table or junk.

    Null and blank texts are left out. Where a language has too few documents, or a text has no known word, the nearest
    prose in its script counts, or in any. Repeated ids stay repeated; an empty table gives an empty result; extra columns
    are dropped.
    """
    prepare(docs.sparkSession)
    stats = staged(statistics(docs, common), "statistics")
    model = fit(stats)

    def of(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, D)
            lang = np.array(batch.column(1).to_pylist(), dtype=object)
            listed, tabled, solid = (batch.column(c).to_numpy() for c in (3, 4, 5))
            best, dist, contrib = np.full(n, "", dtype=object), np.full(n, np.inf), np.zeros((n, D))
            unread = x[:, SYMBOLS] > SYMBOLIC
            for own in set(lang):
                script = own[1:] if own.startswith(":") else SCRIPTS.get(own, "latin")
                names = [own] if own in model else [m for m in model if SCRIPTS.get(m, "latin") == script] or list(model)
                at = np.flatnonzero(lang == own)
                for name in names:
                    c = contributions(x[at], solid[at], *model[name])
                    s = c.sum(axis=1)
                    near = s < dist[at]
                    to = at[near]
                    best[to], dist[to], contrib[to] = name, s[near], c[near]
                    unread[to] = (x[to, SYMBOLS] > SYMBOLIC) | (x[to, COMMON] < model[name][0][COMMON]) & (c[near, COMMON] > FEWER)
            kind = kinds_of(dist, contrib, unread, listed + tabled)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(best, pa.string()), pa.array(np.where(np.isfinite(dist), dist, -1.0)), pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * D, D, dtype=np.int32)), pa.array(contrib.ravel())), pa.array(kind, pa.string())],
                names=["id", "language", "distance", "contributions", "kind"],
            )

    return stats.mapInArrow(of, "id bigint, language string, distance double, contributions array<double>, kind string")


def kinds_of(dist: np.ndarray, contrib: np.ndarray, unread: np.ndarray, marked: np.ndarray) -> list:
    """The kind of each document by its distance and contributions, None for prose: the group of statistics that
    contributes most, if that is more than prose has.

    An exact check follows, since a kind has to fill the larger part of the characters: list and table by the part of
    their lines (marked), junk by having fewer common words than prose, or many symbols (unread).
    """
    names = list(GROUPS)
    part = np.stack([contrib[:, [STATS.index(s) for s in GROUPS[k][0]]].sum(axis=1) for k in names], axis=1)
    top = part.argmax(axis=1)
    found = (dist > FAR) & np.isfinite(dist) & (part.max(axis=1) > np.array([GROUPS[k][1] for k in names])[top])
    found &= np.where(top == names.index("junk"), unread, marked > 0.5)
    return [names[t] if f else None for t, f in zip(top, found)]


def _common(spark: SparkSession, sf_dir: str) -> dict[str, frozenset]:
    out: dict[str, set] = {}
    for r in table(spark, sf_dir, "common_words").collect():  # a fixed table
        out.setdefault(r["language"], set()).add(r["word"])
    return {k: frozenset(v) for k, v in out.items()}


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text"), _common(spark, sf_dir))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).where("kind is not null").select(F.col("id").alias("doc_id"), "kind").distinct()


def p10_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with text: language, squared distance and the statistic that contributes most to it."""
    top = F.expr(f"element_at(array({', '.join(repr(s) for s in STATS)}), int(array_position(contributions, array_max(contributions))))")
    return _run(spark, sf_dir).select(F.col("id").alias("doc_id"), "language", "distance", "contributions", top.alias("leading"), "kind")


QUERIES = {"p10_found": p10_found, "p10_statistics": p10_statistics}
SQL: dict[str, str] = {}
