"""Noise of scanned pages: divided words, misread characters, running heads and page numbers.

Words are counted over the whole corpus. A rare word is joined to frequent ones by anagram hashes: the hash of a word is
the sum of its characters' values, so a confusion shifts it by a fixed difference, and words that differ by one or two
confusions meet in an equi-join on shifted hashes. Corrections are ranked by confusions and frequency. Edge lines are told
by the file's title and page number; a hyphen at a line end is decided by how often the joined and the hyphenated form occur.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.llm.unify import canonical_texts
from pagemill.runtime import prepare, staged, table

# What is printed, and what a reader of scans takes it for.
CONFUSIONS = [
    ("a", "@"), ("a", "4"), ("b", "6"), ("d", "cl"), ("e", "c"), ("e", "f"), ("e", "3"), ("g", "9"), ("h", "b"), ("i", "1"), ("l", "1"), ("i", "l"), ("l", "i"),
    ("m", "rn"), ("n", "ri"), ("o", "0"), ("s", "5"), ("t", "f"), ("t", "7"), ("u", "ii"), ("w", "vv"), ("b", "8"), ("z", "2"),
]
HYPHENS = "-‐‑¬­"
#: A word of letters counts as misread if its correction is at least this many times as frequent; words with a digit or @ in them need a known correction only.
TIMES, KNOWN = 40, 12
#: The most frequent words are not looked up; a fixed bound on what is broadcast.
STOP_WORDS = 5_000
#: Lines longer than this are not wrapped ones.
WIDEST = 120

_TOKEN = re.compile(r"[^\W_]+(?:[@'’][^\W_]+)*@?|@[^\W_]+")
_CODE = re.compile(r"[^\W\d_]?\d+[^\W\d_]?|\d+[^\W\d_]{1,2}")
_PAIR = re.compile(r"(?=\b([^\W\d_]+)-([^\W\d_]+))")
_BREAK = re.compile(rf"([^\W_]*[^\W_@]@?)([{HYPHENS}])[ \t]*\r?\n\s*([^\W_]+)")
_PAGE = re.compile(r"(?:[-—–·•\[(|]\s*)?(?:(?:p|p[a4@]ge|pg|s|seite|p[aá]gina|pag|pág|trang|стр|страница)\.?\s*)?(\d{1,6})(?:\s*(?:/|of|von|de|di|sur|из)\s*\d{1,6})?(?:\s*[-—–·•\])|])?", re.I)
_LEFT = re.compile(rf"([^\W_]*[^\W_@]@?)([{HYPHENS}])[ \t]*$")
_WORD = re.compile(r"[^\W_]+")
_ITEM = re.compile(r"\s*(?:[-–—•*·▪◦‣✓]|\d{1,3}[.)]|\(?[a-zA-Z][.)])\s+\S|\s*#+ ")
_STOPS = ".!?:。！？"
_SKELETON = str.maketrans({"c": "e", "f": "e", "t": "e", "3": "e", "7": "e", "b": "h", "1": "i", "l": "i", "0": "o", "5": "s", "9": "g", "@": "a", "4": "a", "6": "h", "8": "h"})


def skeleton(s: str) -> str:
    """The letters of s without accents, where confusable characters are the same."""
    s = unicodedata.normalize("NFD", s.lower()) if not s.isascii() else s.lower()
    s = "".join(c for c in s if c.isalnum() or c == "@")
    for a, b in (("rn", "m"), ("cl", "d"), ("ri", "n"), ("ii", "u"), ("vv", "w")):
        s = s.replace(a, b)
    return s.translate(_SKELETON)


def title_of(path: str | None) -> tuple[str, ...]:
    """The words of the title in a file's path; its number at the end is dropped."""
    stem = re.sub(r"\.\w+$", "", (path or "").replace("\\", "/").rstrip("/").rpartition("/")[2])
    return tuple(w for w in re.sub(r"[-_ ]*\d+$", "", stem).replace("_", "-").split("-") if w)


class Pages:
    """Tells edge lines of one file's pages."""

    def __init__(self, path: str | None):
        words = title_of(path)
        marks = [skeleton(w) for w in words]
        self.parts = {"".join(marks[i:j]) for i in range(len(words)) for j in range(i + 3, len(words) + 1)} | ({"".join(marks)} if len(words) > 1 else set())
        self.longest = max([0, *(len(p) for p in self.parts)]) * 2 + 20

    def head(self, line: str) -> bool:
        if not 8 <= len(line) <= self.longest or not self.parts:
            return False
        words = line.split()
        while words and not any(c.isalpha() for c in words[0]):
            words = words[1:]
        while words and not any(c.isalpha() for c in words[-1]):
            words = words[:-1]
        return len(words) > 1 and skeleton("".join(words)) in self.parts


def page_mark(line: str, page: int | None) -> bool:
    """Whether the line holds only the page's number mark; where the page is unknown, any mark will do but a bare number."""
    m = _PAGE.fullmatch(line)
    if not m:
        return False
    if page is not None and page >= 0:
        return int(m[1]) == page
    return line != m[1] or len(line) > 1


def parse(text: str, pages: Pages, page: int | None) -> tuple[set[str], list[str]]:
    """The kinds of edge lines in a text, and its other lines."""
    kinds, body = set(), []
    for line in text.split("\n"):
        s = line.strip()
        if 0 < len(s) < 80:
            if s[-1] != "." and len(s) < 24 and any(c.isdigit() for c in s) and page_mark(s, page):
                kinds.add("page_number")
                continue
            if pages.head(s):
                kinds.add("running_head")
                continue
        body.append(line)
    return kinds, body


def words_of(lines: list[str]) -> tuple[list[str], list[tuple[str, str, str]]]:
    """The lower-case words of the lines with words divided at line ends joined, and these divisions (left, mark, right)."""
    body = "\n".join([x for x in lines if x.strip()])
    breaks = []
    if any(h + "\n" in body or h + "\r" in body or h + " " in body for h in HYPHENS):

        def join(m):
            if any(c.isalpha() for c in m[1]) and any(c.isalpha() for c in m[3]):
                breaks.append((m[1].lower(), m[2], m[3].lower()))
                return m[1] + m[3]
            return m[0]

        body = _BREAK.sub(join, body)
    words = _TOKEN.findall(body.lower())
    if words and body.rstrip()[-1:].isalnum():
        words.pop()  # a text may be cut inside its last word
    return words, breaks


def _prepared(batch: pa.RecordBatch, canon):
    """(row, edge kinds, words, divisions, text in consistent form) of each text of a (id, path, page, text) batch."""
    texts = canon(batch.column(3))
    pages: dict = {}
    paths, numbers = batch.column(1).to_pylist(), batch.column(2).to_pylist()
    for i, text in enumerate(texts):
        if text and not text.isspace():
            if paths[i] not in pages:
                pages[paths[i]] = Pages(paths[i])
            kinds, body = parse(text, pages[paths[i]], numbers[i])
            words, breaks = words_of(body)
            yield i, kinds, words, breaks, body


def _as_stored():
    """A stand-in for canonical_texts where the texts are in consistent form already."""
    return lambda texts: texts.to_pylist()


def _vocabulary(form):
    def of(batches):
        canon, count = form(), Counter()

        def out():
            items = [(w, n) for w, n in count.items() if not _CODE.fullmatch(w)]
            count.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in items], pa.string()), pa.array([n for _, n in items], pa.int64())], names=["word", "n"])

        for batch in batches:
            for _, _, words, _, body in _prepared(batch, canon):
                count.update(words)
                for line in body:
                    if "-" in line:
                        count.update([f"{a}-{b}" for a, b in _PAIR.findall(line.lower())])
            if len(count) > 300_000:
                yield out()
        yield out()

    return of


def _marks(stop: frozenset, form):
    def of(batches):
        canon = form()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for i, kinds, words, breaks, _ in _prepared(batch, canon):
                rows += [(ids[i], k, None, None, None) for k in kinds]
                rows += [(ids[i], "split_word", a, h, b) for a, h, b in breaks]
                rows += [(ids[i], "misread", w, None, None) for w in set(words) - stop if not w.isdecimal() and not _CODE.fullmatch(w)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()))], names=["id", "kind", "word", "mark", "rest"])

    return of


def _reached(batches):
    """Keeps the candidates whose word turns into the frequent one by undoing the confusions at some places."""

    def undo(words: set[str], x: str, y: str) -> set[str]:
        return {w[:i] + x + w[i + len(y) :] for w in words for i in range(len(w)) if w.startswith(y, i)}

    for batch in batches:
        keep = []
        for w, f, x, y, x2, y2 in zip(*(batch.column(c).to_pylist() for c in ("word", "right", "x", "y", "x2", "y2"))):
            one = undo({w}, x, y)
            keep.append(f in one if x2 is None else f in undo(one, x2, y2))
        yield batch.filter(pa.array(keep, pa.bool_()))


def vocabulary(chunks: DataFrame, form=canonical_texts) -> DataFrame:
    """(word, n) of all words and hyphenated pairs of words of the running texts, in lower case."""
    return chunks.mapInArrow(_vocabulary(form), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def corrections(words: DataFrame) -> DataFrame:
    """(word, right, edits): the best correction of each rare word by the anagram-hash join."""
    spark = words.sparkSession
    value = "aggregate(split(word, ''), 0L, (s, c) -> s + shiftright(xxhash64(c), 16))"
    named = words.where("not contains(word, '-') and length(word) between 2 and 40")
    frequent = named.where((F.col("n") >= KNOWN) & F.expr("not rlike(word, '[0-9@]')")).select(F.col("word").alias("right"), F.col("n").alias("n_right"), F.expr(value).alias("hash"))
    v = lambda s: F.expr(value.replace("word", f"'{s}'"))
    shifts = F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), (v(x) - v(y)).alias("d")) for x, y in CONFUSIONS])
    least = named.agg(F.max("n")).first()[0] or 0
    rare = named.where(F.col("n") * TIMES <= least).withColumn("own", F.expr(value)).withColumn("shifts", F.filter(shifts, lambda s: F.contains(F.col("word"), s.y)))
    none = F.lit(None).cast("string")
    single = rare.select("word", "n", "own", F.explode("shifts").alias("s"), "shifts")
    one = single.select("word", "n", F.col("s.x").alias("x"), F.col("s.y").alias("y"), none.alias("x2"), none.alias("y2"), (F.col("own") + F.col("s.d")).alias("hash"), F.lit(1).alias("edits"))
    two = single.select("word", "n", "own", "s", F.explode("shifts").alias("t")).where("s.y <= t.y").select("word", "n", F.col("s.x").alias("x"), F.col("s.y").alias("y"), F.col("t.x").alias("x2"), F.col("t.y").alias("y2"), (F.col("own") + F.col("s.d") + F.col("t.d")).alias("hash"), F.lit(2).alias("edits"))
    odd = F.expr("rlike(word, '[0-9@]')")
    met = one.union(two).join(frequent, "hash").where((F.col("n_right") >= F.col("n") * TIMES) | (odd & (F.col("n_right") > F.col("n"))))
    met = met.where("word <> right").where(odd | F.expr("length(word) >= 3 and (edits = 1 or length(word) >= 6)"))
    met = met.select("word", "right", "x", "y", "x2", "y2", "edits", "n_right").mapInArrow(_reached, "word string, right string, x string, y string, x2 string, y2 string, edits int, n_right bigint")
    best = met.withColumn("rank", F.row_number().over(W.partitionBy("word").orderBy("edits", F.desc("n_right"), "right")))
    return best.where("rank = 1").select("word", "right", "edits")


def _noise(chunks: DataFrame, form=canonical_texts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (id, path, page, text) rows: the marks in the texts, the corrections of rare words, and the divisions with their verdicts."""
    spark = prepare(chunks.sparkSession)
    chunks = chunks.select("id", "path", "page", "text").where("id is not null and text is not null")
    words = staged(vocabulary(chunks, form), "words")
    stop = frozenset(r[0] for r in words.where("not rlike(word, '[0-9@-]')").orderBy(F.desc("n"), "word").limit(STOP_WORDS).collect())
    right = staged(corrections(words), "corrections")
    stop -= {r[0] for r in right.where(F.col("word").isin(list(stop)) if stop else F.lit(False)).collect()}
    marks = staged(chunks.mapInArrow(_marks(stop, form), "id bigint, kind string, word string, mark string, rest string"), "marks")
    known = lambda name: words.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"))
    split = marks.where("kind = 'split_word'").select("id", "kind", "word", "rest", F.concat("word", "rest").alias("joined"), F.concat_ws("-", "word", "rest").alias("pair"))
    for name in ("joined", "pair", "word", "rest"):
        split = split.join(known(name), name, "left")
    split = split.withColumn("compound", F.expr("coalesce(n_pair, 0) > coalesce(n_joined, 0)"))
    # two known words whose joined form is next to unknown were only met there, e.g. a line of another origin between them
    return marks, right, split.withColumn("accepted", F.expr(f"not compound and coalesce(n_joined, 0) * {TIMES} >= least(coalesce(n_word, 0), coalesce(n_rest, 0))"))


def scan_noise(chunks: DataFrame) -> DataFrame:
    """(id, kind), each once, for the kinds of scanning noise in the texts of (id, path, page, text) rows.

    Null and blank texts have none; a null path has no running heads; with a null or negative page any page mark counts.
    Rows sent again count twice in the word frequencies and once in the result; an empty table gives an empty result.
    """
    marks, right, split = _noise(chunks)
    edge = marks.where("kind in ('running_head', 'page_number')").select("id", "kind")
    misread = marks.where("kind = 'misread'").join(right, "word", "left_semi").select("id", "kind")
    return edge.union(misread).union(split.where("accepted").select("id", "kind")).distinct()


def _cased(word: str, right: str, begins: bool) -> str:
    """right in the case of word; where word begins with a digit or mark, its case is that of its place."""
    letters = [c for c in word if c.isalpha()]
    if len(letters) > 1 and all(c.isupper() for c in letters):
        return right.upper()
    return right[:1].upper() + right[1:] if (word[0].isupper() if word[0].isalpha() else begins) else right


def _fields(line: str) -> bool:
    """Whether the line is a row of a table."""
    s = line.strip()
    return s[0] == "|" or "\t" in s or "   " in s or any((n := s.count(m)) > 1 and m + " " not in s and s.count(" ") <= 2 * n for m in ",;")


def _width(lines: list[str]) -> int:
    """The width at which the lines are wrapped: that below which most lines end closely; 0 if they aren't wrapped."""
    sizes = [len(x) for x in lines]
    near, w = max(((sum(s - 10 < x <= s for x in sizes), -s) for s in sizes), default=(0, 0))
    return -w if near > 1 and -w <= WIDEST else 0


def reflow(text: str, pages: Pages, page: int | None, joins: dict[tuple[str, str], str]) -> str:
    """The text without its edge lines and with each paragraph on one line. joins: what stands between the parts of a
    word divided at a line end, by the parts. Lines of lists and tables stay, blank lines stay as one; around an edge
    line they are none of the text's own."""
    blocks: list[list[str]] = []
    blank, edge = True, False
    for line in text.split("\n"):
        if not (s := line.strip()):
            blank = True
        elif len(s) < 80 and not parse(line, pages, page)[1]:
            edge = True
        else:
            if not blocks or blank and not edge:
                blocks.append([])
            blocks[-1].append(line.rstrip())
            blank = edge = False
    width = _width([x.strip() for b in blocks for x in b])
    out = []
    for lines in blocks:
        items = len(lines) > 2 and all(x.strip()[:1].isupper() and x[-1] not in _STOPS for x in lines)
        whole = [lines[0]]
        for before, line in zip(lines, lines[1:]):
            s, size = line.strip(), len(before.strip())
            m, n = (_LEFT.search(before), _WORD.match(s)) if joins and before[-1] in HYPHENS else (None, None)
            if m and n and (between := joins.get((m[1].lower(), n[0].lower()))) is not None:
                whole[-1] = whole[-1][: m.start(2) - len(before)] + between + s
            elif items or _fields(before) or _fields(line) or _ITEM.match(line):
                whole.append(line)
            else:
                wide = any("\u3040" <= c <= "\u9fff" for c in (before[-1], s[0]))
                goes_on = s[0].islower() and before[-1] not in _STOPS
                # the next word had no room left on the line
                full = size <= width + 3 and len(s) <= width + 3 and size + (1 if wide else 1 + len(s.split()[0])) >= width - 2
                if goes_on or width and full:
                    whole[-1] += s if wide else " " + s
                else:
                    whole.append(line)
        out.append("\n".join(whole))
    return "\n\n".join(out)


def _consistent(batches):
    canon = canonical_texts()
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(canon(batch.column(3)), pa.string())], names=["id", "path", "page", "text"])


def _repair(batches):
    for batch in batches:
        ids, paths, numbers, fixes = (batch.column(c).to_pylist() for c in ("id", "path", "page", "fixes"))
        texts = batch.column("text").to_pylist()
        pages: dict = {}
        for i, t in enumerate(texts):
            if not t or t.isspace():
                continue
            if paths[i] not in pages:
                pages[paths[i]] = Pages(paths[i])
            fix = fixes[i] or []
            t = reflow(t, pages[paths[i]], numbers[i], {(f["word"], f["rest"]): f["to"] for f in fix if f["rest"] is not None})
            right = {f["word"]: f["to"] for f in fix if f["rest"] is None}
            if right:

                def put(m, right=right):
                    to = right.get(m[0].lower())
                    return m[0] if to is None else _cased(m[0], to, m.string[: m.start()].rstrip()[-1:] in ("", *_STOPS))

                t = _TOKEN.sub(put, t)
            texts[i] = t
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])


def repaired(chunks: DataFrame) -> DataFrame:
    """(id, text), each id once, of (id, path, page, text) rows: the text in consistent form, without edge lines, words
    divided at line ends joined, misread words corrected, each paragraph on one line.

    Null texts stay null, blank ones blank. A compound broken at its own hyphen keeps it. Of rows sent again one stays.
    """
    prepare(chunks.sparkSession)
    chunks = chunks.select("id", "path", "page", "text").where("id is not null")
    chunks = staged(chunks.mapInArrow(_consistent, "id bigint, path string, page int, text string"), "consistent")
    marks, right, split = _noise(chunks, _as_stored)
    word = marks.where("kind = 'misread'").join(right, "word").select("id", "word", F.lit(None).cast("string").alias("rest"), F.col("right").alias("to"))
    parts = split.where("accepted or compound").select("id", "word", "rest", F.when(F.col("compound"), "-").otherwise("").alias("to"))
    fixes = staged(word.union(parts), "fixes").groupBy("id").agg(F.collect_set(F.struct("word", "rest", "to")).alias("fixes"))
    once = chunks.withColumn("nth", F.row_number().over(W.partitionBy("id").orderBy(F.col("text").isNull(), F.desc("page"), "path", "text"))).where("nth = 1").drop("nth")
    return once.join(fixes, "id", "left").mapInArrow(_repair, "id bigint, text string")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), "path", F.col("page_number").alias("page"), "text")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_noise(_chunks(spark, sf_dir)).select(F.col("id").alias("chunk_id"), "kind")


def p1_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk once, its text repaired and in continuous paragraphs."""
    return repaired(_chunks(spark, sf_dir)).select(F.col("id").alias("chunk_id"), "text")


QUERIES = {"p1_found": p1_found, "p1_repaired": p1_repaired}
SQL: dict[str, str] = {}
