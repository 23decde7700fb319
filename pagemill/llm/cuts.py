"""Texts cut off by field limits or in transfer.

The hazard of a length in a source is the share of its texts that end at that length among those that reach it. Window
functions give each length's hazard and that of its neighbours; where far more texts end than reach the length times the
neighbours' hazard (a Chernoff bound of the Poisson tail, false discoveries controlled over all tests) the source has a limit there.
At a limit every ending that isn't complete is a cut. Elsewhere only an ending that can't be one: inside a sentence, a
bracket, a word's bytes or a table row.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.llm import kernels as K
from pagemill.llm.lines import LEAST_LETTERS, line_keys
from pagemill.llm.scans import Pages, page_mark
from pagemill.llm.unify import canonical_texts
from pagemill.runtime import prepare, small, staged, table

#: Neighbouring lengths looked at on either side; ends a limit needs at least; false discovery rate; units below the limit that count (marks and split characters).
NEAR, LEAST_ENDS, RATE, SLACK = 25, 5, 0.001, 4
COMPLETE, OPEN, BROKEN = 0, 1, 2
#: Least share of a source's texts, or of all texts, that end with a notice; share of the places where a pair of words begins a line or sentence at which the sentence is finished, so that the pair shows a sentence begun, and the one-sided normal quantile of the test that it's larger.
NOTICE, NOTICE_ANYWHERE, OPENINGS, SURE = 0.005, 0.0001, 0.5, 1.645

_ENDS = ".!?。！？"
_CLOSERS = "\"'”’»)]）」』✓*†"
_REFERENCE = re.compile(r"\s*(?:\[\d{1,4}\]|\((?:[A-Z]?\d[\d.,-]*)\)|✓)\s*$")
_MARKER = re.compile(r"\s*(?:[-–—•*·▪◦‣]|\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+(?=\S)")
_INSIDE = re.compile(r"[.!?]\s+[^\W\d_]|[。！？]\S")
_START = re.compile(r"\s*([^\W\d_]+)['’ ]([^\W\d_]+)[\W\d]")
_OPENING = re.compile(r"(?:^[ \t]*|(?<=[.!?] ))([^\W\d_]+)['’ ]([^\W\d_]+)(?=\W|$)", re.M)
_FINISH = re.compile(r"(?:[^.!?\n]|[.!?](?!\s|$)|\n(?=[^\W\d_A-ZÀ-ÖØ-Þ]))*[.!?](?=\s|$)")
_LETTERS = re.compile(r"[^\W\d_]+")
_FIELDS = ("|", "\t", ";", ",")


def _row(line: str) -> tuple[str, int] | None:
    """The field mark of a table row, and the number of marks."""
    s = line.strip("\r\n ")
    if s.startswith("|"):
        return "|", s.count("|")
    for m in ("\t", ";"):
        if line.count(m):
            return m, line.rstrip("\r\n").count(m)
    if line.count(",") and not re.search(r",\s", line):
        return ",", line.count(",")
    if re.search(r"\S {3,}\S|\S  +\S.*\S  +\S", line):
        return "  ", len(re.findall(r"\S {2,}(?=\S)", line))
    return None


def _japanese(s: str) -> bool:
    return any("぀" <= c <= "ヿ" or "一" <= c <= "鿿" for c in s)


def ending(text: str, common: frozenset, pages: Pages, page: int | None) -> int:
    """Whether a text's end is complete, open (a list item, a heading, a word: can't be told) or broken."""
    t = text.rstrip()
    if not t:
        return COMPLETE
    if t[-1] == "�":
        return BROKEN
    if t.endswith("…") or t.endswith("..."):
        return BROKEN
    lines = t.split("\n")
    last = lines[-1].strip()
    if page_mark(last, page) or pages.head(last):
        return COMPLETE
    before = [x for x in (y.rstrip("\r") for y in lines[:-1]) if x.strip()]
    row = _row(lines[-1])
    peers = [p for p in map(_row, before[-3:]) if p]
    if peers and (row or peers[-1][0] in "|\t;"):
        mark, n = peers[-1]
        if mark == "|":
            return COMPLETE if row and row == peers[-1] and last.endswith("|") else BROKEN
        if mark in "\t;":
            here = lines[-1].rstrip("\r").count(mark)
            if len(peers) > 1 and peers[-2] == peers[-1]:
                return COMPLETE if here == n and not last.endswith(mark) else BROKEN if here < n else OPEN
            return OPEN
        if mark == "," and len(peers) > 1 and peers[-2][0] == ",":
            here = last.count(",")
            return COMPLETE if here >= n else BROKEN
        if mark == "  " and len(peers) > 1 and row:
            return OPEN
    s = t
    while m := _REFERENCE.search(s):
        s = s[: m.start()]
    s = s.rstrip()
    if not s:
        return COMPLETE
    body = s.split("\n")[-1]
    if s[-1] in _ENDS or s.rstrip(_CLOSERS)[-1:] in _ENDS and s[-1] in _CLOSERS:
        tail = re.split(r"[.!?。]\s", body[:-1])[-1]
        return BROKEN if tail.count("(") > tail.count(")") + (s[-1] == ")") and s[-1] == "." else COMPLETE
    if len(s) < len(t):
        return COMPLETE
    if last.startswith("—") or re.match(r"[^\W\d_]+(?: [^\W\d_]+){0,2}: [A-ZÀ-ÖØ-Þ]", last) and not _INSIDE.search(last) and len(last) < 60:
        return COMPLETE
    if _MARKER.match(lines[-1]) and (before and _MARKER.match(before[-1]) or not _INSIDE.search(last)):
        return OPEN
    if _INSIDE.search(last):
        return BROKEN
    ended = not before or before[-1].rstrip().rstrip(_CLOSERS)[-1:] in _ENDS
    if _japanese(last):
        return BROKEN if "、" in last or "は" in last else OPEN
    if not ended:
        # a list without markers has short lines that all begin with a capital letter; wrapped prose goes on in lower case
        tail = before[-3:] + [last]
        if len(tail) > 2 and all(x.strip()[:1].isupper() for x in tail) and max(map(len, tail)) < 75 and not any(x.rstrip()[-1:] in _ENDS for x in tail):
            return OPEN
        if last[:1].islower() and len(before) > 1 and len(before[-1]) > 30:
            return BROKEN
    elif before and sum(w in common for w in (w.lower() for w in _LETTERS.findall(last))) > 1:
        return BROKEN
    return OPEN


def _ends(common: frozenset):
    def of(batches):
        canon = canonical_texts()
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            raw, texts = batch.column(4).to_pylist(), canon(batch.column(4))
            paths, numbers = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            pages: dict = {}
            end = np.zeros(n, np.int32)
            for i, t in enumerate(texts):
                if t:
                    p = pages.get(paths[i]) or pages.setdefault(paths[i], Pages(paths[i]))
                    end[i] = ending(t, common, p, numbers[i])
            lasts = [(t or "").rstrip().rpartition("\n")[2] for t in raw]
            key, size, _, _ = line_keys(lasts)
            start = _start_keys([m.group(1, 2) if (m := _START.match(t)) and m[1][0].isupper() else None for t in ((x or "").rstrip().rpartition("\n")[2] for x in texts)])
            chars = np.array([len(t) for t in raw], np.int32)
            octets = np.array([len(t.encode("utf-8", "surrogatepass")) for t in raw], np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(chars), pa.array(octets), pa.array(end), pa.array(np.where(size >= LEAST_LETTERS, key, 0)), pa.array(start)],
                names=["id", "source", "chars", "octets", "ending", "key", "start"],
            )

    return of


def _start_keys(pairs: list) -> np.ndarray:
    """Hashes of pairs of words; of None 0."""
    out = np.zeros(len(pairs), np.int64)
    at = [i for i, p in enumerate(pairs) if p]
    if at:
        a, sep = K.code_points([" ".join(pairs[i]) for i in at])
        out[at] = K.range_hashes(a, np.r_[0, sep[:-1] + 1], sep).view(np.int64)
    return out


def _openings(batches):
    """Counts of the first two words of lines and sentences: all, and those of finished sentences."""
    count: Counter = Counter()
    whole: Counter = Counter()

    def out():
        pairs = list(count)
        batch = pa.RecordBatch.from_arrays([pa.array(_start_keys(pairs)), pa.array([count[p] for p in pairs], pa.int64()), pa.array([whole[p] for p in pairs], pa.int64())], names=["start", "n", "whole"])
        count.clear()
        whole.clear()
        return batch

    for batch in batches:
        for t in batch.column(0).to_pylist():
            for m in _OPENING.finditer(t):
                if m[1][0].isupper():
                    count[m.groups()] += 1
                    if _FINISH.match(t, m.end()):
                        whole[m.groups()] += 1
        if len(count) > 300_000:
            yield out()
    yield out()


def opening_pairs(texts: DataFrame) -> DataFrame:
    """(start) of the pairs of words that go on to a finished sentence in more than OPENINGS of their places, by the lower
    Wilson bound: a share, so that more of the same texts don't turn a heading into a sentence. One place is the
    judged text's own unfinished end and doesn't count."""
    n = texts.mapInArrow(_openings, "start bigint, n bigint, whole bigint").where("start <> 0").groupBy("start").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"))
    n = n.withColumn("n", F.greatest(F.col("n") - 1, "whole")).where("whole > 0").withColumn("p", F.col("whole") / F.col("n"))
    z = SURE * SURE
    low = (F.col("p") + z / 2 / F.col("n") - SURE * F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("n") + z / 4 / F.col("n") / F.col("n"))) / (1 + z / F.col("n"))
    return n.where(low > OPENINGS).select("start")


def limits(ends: DataFrame) -> DataFrame:
    """(source, unit, length, hazard, near_hazard, p) of the lengths at which a source cuts its texts: those at which more
    texts end than reach them times the hazard of the neighbouring lengths foretells. One row per text in `ends`; null
    sources are one group. Window functions run over lengths of one source, not over its texts."""
    both = ends.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("octets").alias("unit"), F.col("octets").alias("length")))).alias("u")).select("source", "u.*")
    counts = both.groupBy("source", "unit", "length").agg(F.count("*").alias("n"))
    by = W.partitionBy("source", "unit")
    c = counts.withColumn("reach", F.sum("n").over(by.orderBy(F.desc("length"))))
    near = by.orderBy("length").rangeBetween(-NEAR, NEAR)
    # at risk: the texts that reach a length, over it and the lengths before it at which none ends; none is below the shortest
    gap = F.least(F.coalesce(F.col("length") - F.lag("length").over(by.orderBy("length")), F.lit(1)), F.lit(NEAR))
    c = c.withColumn("hazard", F.col("n") / F.col("reach")).withColumn("risk", F.col("reach") * gap)
    c = c.withColumn("others", F.sum("n").over(near) - F.col("n")).withColumn("risk", F.greatest(F.sum("risk").over(near) - F.col("reach"), "reach"))
    # one end more than there are: no neighbour foretells nothing at all
    c = c.withColumn("near_hazard", (F.col("others") + 1) / F.col("risk")).withColumn("expected", F.col("reach") * F.col("near_hazard"))
    c = c.withColumn("log_p", F.when((F.col("n") >= LEAST_ENDS) & (F.col("n") > F.col("expected")), -(F.col("n") * F.log(F.col("n") / F.col("expected")) - F.col("n") + F.col("expected"))).otherwise(0.0))
    # Benjamini-Hochberg over all tests by a histogram of -log p in steps of 0.1: a table of bounded size, not a global sort
    steps = c.withColumn("step", F.least(F.floor(-F.col("log_p") * 10), F.lit(5000)))
    hist = steps.groupBy("step").agg(F.count("*").alias("m"))
    hist = hist.withColumn("rank", F.sum("m").over(W.orderBy(F.desc("step")))).withColumn("tests", F.sum("m").over(W.partitionBy()))
    cut = hist.where(F.exp(-F.col("step") / 10) <= RATE * F.col("rank") / F.col("tests")).agg(F.min("step").alias("cut"))
    return steps.join(F.broadcast(cut), F.col("step") >= F.col("cut")).where("step > 0").select("source", "unit", "length", "hazard", "near_hazard", F.exp("log_p").alias("p"))


def truncated(chunks: DataFrame, common: frozenset) -> tuple[DataFrame, DataFrame]:
    """Cut texts (id, source, at_limit) among (id, source, path, page, text) rows, and all texts (id, source), each once.

    Null and blank texts are not cut. Rows sent again count once. Notices at the end are
    complete ends, by their share of a source. An empty table gives empty results.
    """
    prepare(chunks.sparkSession)
    chunks = chunks.select("id", "source", "path", "page", "text").where("id is not null and rlike(text, '\\\\S')")
    ends = chunks.mapInArrow(_ends(common), "id bigint, source string, chars int, octets int, ending int, key bigint, start bigint")
    ends = staged(ends.dropDuplicates(["id"]), "ends")
    found = staged(limits(ends), "limits")
    maybe = ends.where(f"ending > {COMPLETE}")
    # a notice is the last line of a hundredth of its source's texts; its line is complete in any source
    n = ends.groupBy("source").agg(F.count("*").alias("n_source"))
    last = maybe.where("key <> 0").groupBy("source", "key").agg(F.count("*").alias("n")).withColumnRenamed("source", "s")
    notices = last.join(n, F.col("s").eqNullSafe(n.source)).where((F.col("n") >= LEAST_ENDS) & (F.col("n") >= F.col("n_source") * NOTICE)).select("key")
    everywhere = last.groupBy("key").agg(F.sum("n").alias("n")).join(ends.agg(F.count("*").alias("n_all")).hint("broadcast")).where((F.col("n") >= LEAST_ENDS) & (F.col("n") >= F.col("n_all") * NOTICE_ANYWHERE)).select("key")
    notices = notices.union(everywhere).distinct()
    maybe = maybe.join(notices, "key", "left_anti")
    openings = opening_pairs(chunks.select("text")).withColumn("opened", F.lit(BROKEN))
    maybe = staged(maybe.join(openings, "start", "left").withColumn("ending", F.coalesce("opened", "ending")).drop("opened"), "maybe")
    hit = small(staged(found.select("source", "unit", F.explode(F.expr(f"sequence(length - {SLACK}, length)")).alias("length")).distinct(), "hit"), 500_000)
    at = maybe.select("id", "source", F.explode(F.expr("array(struct('chars' as unit, chars as length), struct('octets' as unit, octets as length))")).alias("u")).select("id", "source", "u.*")
    at = at.join(hit, at.source.eqNullSafe(hit.source) & (at.unit == hit.unit) & (at.length == hit.length), "left_semi").select("id").distinct().withColumn("limited", F.lit(True))
    cut = maybe.join(at, "id", "left").where(F.col("limited").isNotNull() | (F.col("ending") == BROKEN))
    return cut.select("id", "source", F.coalesce("limited", F.lit(False)).alias("at_limit")), ends.select("id", "source")


def _input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, frozenset]:
    common = frozenset(r[0] for r in table(spark, sf_dir, "common_words").select("word").collect())  # a fixed table
    return table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), F.col("source_name").alias("source"), "path", F.col("page_number").alias("page"), "text"), common


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(*_input(spark, sf_dir))[0].select(F.col("id").alias("chunk_id"))


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates: texts, cut texts, of these at one of its limits."""
    cut, every = truncated(*_input(spark, sf_dir))
    n = every.groupBy("source").agg(F.count("*").alias("n_texts"))
    c = cut.groupBy("source").agg(F.count("*").alias("n_cut"), F.count_if("at_limit").alias("n_at_limit")).withColumnRenamed("source", "s")
    j = n.join(c, n.source.eqNullSafe(c.s), "left")
    return j.select(F.col("source").alias("source_name"), "n_texts", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), F.coalesce("n_at_limit", F.lit(0)).alias("n_at_limit"), F.round(F.coalesce("n_cut", F.lit(0)) / F.col("n_texts"), 6).alias("share"))


QUERIES = {"p5_found": p5_found, "p5_sources": p5_sources}
SQL: dict[str, str] = {}
