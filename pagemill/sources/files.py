"""File sources and sinks: binary scans with routing by suffix, texts, HTML, CSV, records, and table writers."""

from __future__ import annotations

import csv
import html
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.operators.ordered import token_windows
from pagemill.runtime import prepare

# The suffixes of each family, and the order in which families are joined again.
SUFFIXES = {"pdf": "pdf", "doc": "docx pptx", "image": "jpg jpeg png tiff tif bmp svg", "text": "txt md json sh", "html": "html", "spreadsheet": "csv", "workbook": "xlsx xls", "audio": "mp3 wav m4a", "video": "mp4 mov mkv"}
FAMILIES = {x: f for f, names in SUFFIXES.items() for x in names.split()}
ORDER = ("pdf", "doc", "image", "text", "html", "spreadsheet", "workbook", "audio", "video")
WRAPPERS = ("records", "df_records", "extracted_df_records", "primitives")


def expand_paths(patterns: list[str], spark: SparkSession | None = None) -> list[str]:
    """Sorted matches of globs and literal paths, on any file system the session knows; a missing literal path or a folder
    is an error, an empty glob isn't."""
    spark = spark or SparkSession.getActiveSession()
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: set[str] = set()
    for p in patterns:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if any(c in p for c in "*?[{"):
            found = list(fs.globStatus(path) or [])
        elif fs.exists(path):
            found = [fs.getFileStatus(path)]
        else:
            raise FileNotFoundError(p)
        for f in found:
            if f.isDirectory():
                raise IsADirectoryError(f.getPath().toString())
            out.add(f.getPath().toString())
    return sorted(out)


def family_of(path: Column) -> Column:
    """The family of a path by its suffix; null for an unknown one."""
    pairs = [F.lit(x) for kv in FAMILIES.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)))


def scan(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content, family) of the files, distributed."""
    return spark.read.format("binaryFile").load(paths).select("path", "content", family_of(F.col("path")).alias("family"))


def branches(files: DataFrame, readers: dict, strict: bool = False) -> DataFrame:
    """Each family through its reader (DataFrame to DataFrame), joined in a fixed order with missing columns as nulls.
    strict: a file of an unknown family or of one without a reader is an error, else it gives a row of path and error."""
    read = F.coalesce(F.col("family").isin([f for f in ORDER if f in readers]), F.lit(False))
    if strict:
        files = files.where(F.when(~read, F.raise_error(F.concat(F.lit("unsupported file: "), "path")).cast("boolean")).otherwise(F.lit(True)))
    parts = [readers[f](files.where(F.col("family") == f)) for f in ORDER if f in readers]
    if not strict:
        parts.append(files.where(~read).select("path", F.concat(F.lit("no reader: "), F.coalesce("family", F.lit("unknown family"))).alias("error")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def text_chunks(files: DataFrame, size: int = 1024, overlap: int = 0) -> DataFrame:
    """(path, chunk_index, text) of text files; undecodable bytes are replaced, blank files give nothing."""
    t = files.select("path", F.posexplode(token_windows(F.make_valid_utf8(F.col("content").cast("string")), size, overlap)).alias("chunk_index", "text"))
    return t.where("trim(text) <> ''")


# Elements whose text isn't shown; of these, those that hold no markup.
HIDDEN, RAW = ("script", "style", "noscript", "template"), ("script", "style")
_MARKUP = re.compile(r"<!--.*?(?:-->|$)|<!\w[^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][\w:-]*)(?:\"[^\"]*\"|'[^']*'|[^'\">])*>", re.S)


def html_text(page: str) -> str:
    """The shown text of a page: its pieces between markup, stripped, blank ones dropped, a blank line between. A hidden
    element that isn't closed hides all that follows; hidden elements may lie in each other."""
    pieces, within, at, end = [], [], 0, len(page)
    while at < end:
        m = re.compile(rf"</{within[-1]}\s*>", re.I).search(page, at) if within and within[-1] in RAW else _MARKUP.search(page, at)
        if not within:
            pieces.append(page[at : m.start() if m else end])
        if not m:
            break
        name = within[-1] if m.re is not _MARKUP else (m[2] or "").lower()
        if m.re is not _MARKUP or m[1]:
            if name in within:
                del within[len(within) - 1 - within[::-1].index(name) :]
        elif name in HIDDEN and not m[0].endswith("/>"):
            within.append(name)
        at = m.end()
    return "\n\n".join(t for t in (html.unescape(p).strip() for p in pieces) if t)


def html_pages(files: DataFrame) -> DataFrame:
    prepare(files.sparkSession)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"path": pdf["path"], "text": [html_text(bytes(c).decode("utf-8", "replace")) for c in pdf["content"]]})

    return files.select("path", "content").mapInPandas(of, "path string, text string").where("trim(text) <> ''")


def decode_csv(payload: bytes) -> str:
    for e in ("utf-8-sig", "utf-8", "cp1252"):
        try:
            return payload.decode(e)
        except UnicodeDecodeError:
            continue
    return payload.decode("latin-1")


def csv_table(payload: bytes) -> list[list[str]]:
    """Rows of a CSV file: the delimiter that gives the most stable width above one, blank rows dropped, short rows padded,
    surplus fields joined to the last column or to the first that holds an embedded image."""
    text = decode_csv(payload)
    best, rows = (-1.0, 0), []
    for d in ",;\t|":
        got = [r for r in csv.reader(io.StringIO(text), delimiter=d) if any(c.strip() for c in r)]
        widths = [len(r) for r in got]
        width = max(set(widths), key=lambda w: (widths.count(w), w)) if widths else 0
        mark = (widths.count(width) / len(widths) if width > 1 else 0.0, width)
        if widths and widths[0] == width and width > 1:
            mark = (mark[0] + 0.5, width)
        if mark > best:
            best, rows, used = mark, got, d
    if not rows:
        return []
    n = len(rows[0])
    out = [rows[0]]
    for r in rows[1:]:
        r = list(r)
        if len(r) > n:
            at = next((i for i, c in enumerate(r) if c.startswith("data:image")), n - 1)
            at = min(at, n - 1)
            extra = len(r) - n
            sep = "," if r[at].startswith("data:image") and r[at].endswith("base64") else used
            r = r[:at] + [sep.join(r[at : at + extra + 1])] + r[at + extra + 1 :]
        out.append(r + [""] * (n - len(r)))
    return out


def csv_chunks(files: DataFrame, budget: int = 4096) -> DataFrame:
    """(path, chunk_index, text) of CSV files as markdown rows, cut where the budget of characters is reached."""
    prepare(files.sparkSession)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"]):
                t = csv_table(bytes(content))
                if not t:
                    continue
                line = lambda r: "| " + " | ".join(c.replace("|", "\\|").replace("\n", " ") for c in r) + " |"
                head, group, size, k = line(t[0]), [], 0, 0
                for r in map(line, t[1:]):
                    if group and size + len(r) > budget:
                        rows.append((path, k, "\n".join([head, *group])))
                        group, size, k = [], 0, k + 1
                    group.append(r)
                    size += len(r)
                rows.append((path, k, "\n".join([head, *group])))
            yield pd.DataFrame(rows, columns=["path", "chunk_index", "text"])

    return files.select("path", "content").mapInPandas(of, "path string, chunk_index int, text string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, CSV with a header, JSON lines or JSON; a document that wraps its records under a known key is unwrapped."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).csv(path)
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    df = spark.read.option("multiLine", path.endswith(".json")).json(path)
    key = next((k for k in WRAPPERS if k in df.columns), None)
    return df.select(F.inline(key)) if key else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite", least_dim: int | None = None, sparse: bool = False) -> DataFrame:
    """Writes valid rows of a vector table (a vector of the dimension and some text; an image with a vector needs no text;
    with `sparse` only text) and returns the counters of what was dropped, observed in the same pass. Overwrite is the
    default; append creates the table, never de-duplicates, and is an error if the table there has other columns or vectors
    of another length."""
    from pyspark.sql import Observation

    spark = df.sparkSession
    if mode == "append":
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            old = spark.read.parquet(path)
            if {(f.name, f.dataType.simpleString()) for f in old.schema} != {(f.name, f.dataType.simpleString()) for f in df.schema}:
                raise ValueError("the table there has other columns")
            there = None if sparse else old.select(F.size("embedding")).first()
            if there and least_dim is not None and there[0] != least_dim:
                raise ValueError("the table there has vectors of another length")
    seen = Observation()
    has = F.lit(True) if sparse else F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    fit = has if least_dim is None or sparse else has & (F.size("embedding") == least_dim)
    text = F.coalesce(F.trim("text"), F.lit("")) != ""
    if "content_type" in df.columns and not sparse:
        text = text | F.coalesce(F.col("content_type") == "image", F.lit(False))
    df.observe(seen, F.count_if(~has).alias("dropped_no_embedding"), F.count_if(has & ~fit).alias("dropped_bad_length"), F.count_if(fit & ~text).alias("dropped_no_text"), F.count_if(fit & text).alias("written")).where(fit & text).write.mode(mode).parquet(path)
    got = seen.get
    return spark.createDataFrame([tuple(int(got[k]) for k in sorted(got))], ", ".join(f"{k} bigint" for k in sorted(got)))


def write_records(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet, or JSON lines where the path ends so."""
    (df.write.mode(mode).json if path.endswith((".json", ".jsonl", ".ndjson")) else df.write.mode(mode).parquet)(path)


def transport(df: DataFrame, bulky: tuple[str, ...] = ("embedding", "content", "image_b64", "page_image"), most: int = 500) -> DataFrame:
    """Results as they travel: bulky columns null, texts cut at `most` characters but those that carry the text."""
    kept = ("text", "content", "markdown", "page_text")
    cut = lambda f: F.lit(None).cast(f.dataType).alias(f.name) if f.name in bulky and f.name not in kept else F.substring(f.name, 1, most).alias(f.name) if f.dataType.simpleString() == "string" and f.name not in kept else F.col(f.name)
    return df.select(*[cut(f) for f in df.schema.fields])
