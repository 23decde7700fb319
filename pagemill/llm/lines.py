"""Lines repeated across one source's documents.

Lines are compared by their letters in lower case. Copies of a document are collapsed first: equal ones by their lines, and
for the boilerplate lightly edited ones too, by near-duplicate links. Each cluster counts a line once, with the number of
its members and its range of publication dates, so that republished articles can be told from boilerplate; the counts of
lines are partial sums over clusters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import kernels as K
from pagemill.llm.neardup import similar_pairs
from pagemill.operators.graph import components
from pagemill.runtime import prepare, small, staged, table

LEAST_LETTERS, LEAST_CHUNKS, LEAST_SHARE = 8, 5, 0.05
#: Distinct clusters and publication dates that have a line of boilerplate at least.
LEAST_CLUSTERS, LEAST_DAYS = 5, 2
#: Rows of a staged table that may be broadcast (under 50 MB).
BROADCAST_ROWS = 1_000_000


def line_keys(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each line of all texts: the hash of its letters, how many there are, its text, its number in the text."""
    a, sep = K.code_points(texts)
    letter = K.lookup(a, "alpha")
    brk = np.flatnonzero((a == 10) | (a == K.SEP))
    starts = np.r_[0, brk[:-1] + 1] if len(brk) else np.zeros(0, np.int64)
    before = np.r_[0, np.cumsum(letter)]
    lo, hi = before[starts], before[brk]
    doc = np.searchsorted(sep, starts)
    first = np.searchsorted(doc, np.arange(len(texts)))
    return K.range_hashes(a[letter], lo, hi).view(np.int64), hi - lo, doc, np.arange(len(doc)) - first[doc]


def _per_chunk(batches):
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key, size, doc, _ = line_keys(batch.column(3).to_pylist())
        cluster = np.zeros(n, np.uint64)
        np.add.at(cluster, doc, K.mix(key.view(np.uint64)))
        use = size >= LEAST_LETTERS
        key, doc = key[use], doc[use]
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])] if len(key) else np.zeros(0, bool)
        key, doc = key[new], doc[new]
        off = np.r_[0, np.cumsum(np.bincount(doc, minlength=n))].astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(cluster.view(np.int64)), pa.ListArray.from_arrays(pa.array(off), pa.array(key))], names=["id", "source", "day", "cluster", "keys"])


def _each_line(batches):
    for batch in batches:
        if batch.num_rows:
            key, size, doc, number = line_keys(batch.column(2).to_pylist())
            use = size >= LEAST_LETTERS
            at = pa.array(doc[use])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(number[use].astype(np.int64)), pa.array(key[use])], names=["id", "source", "line_no", "key"])


def near_clusters(chunks: DataFrame) -> DataFrame:
    """(id, cluster) of the (id, text) rows whose texts have words: equal texts and those linked by five words and a
    similarity of 0.8 are one cluster."""
    links, members = similar_pairs(chunks)
    groups = components(staged(links.select("a", "b"), "links"))
    return members.join(groups, "node", "left").select("id", F.coalesce("component", "node").alias("cluster"))


def collapsed(once: DataFrame) -> DataFrame:
    """(source, cluster, keys, n, first_day, last_day): the (id, source, day, cluster, keys) rows of a cluster that have the
    same lines as one row, with their number and range of days, so that a text sent out often hands on its lines once."""
    return once.groupBy("source", "cluster", "keys").agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def repeated_lines(chunks: DataFrame, least_chunks: int = LEAST_CHUNKS, share: float = LEAST_SHARE, about: DataFrame | None = None) -> DataFrame:
    """(source, key, n_chunks, n_clusters, n_days, n_source) of the lines that stand in at least `least_chunks`
    chunks and that share of all distinct chunks of their source.

    chunks: (id, source, day, text); ids sent again count once, chunks with null or blank text count in n_source only,
    rows with a null id or a null or blank source are left out. An empty table gives an empty result. about: (id, cluster,
    day) of chunks whose cluster or day isn't that of their equal lines and own row; nulls leave these as they are.
    """
    prepare(chunks.sparkSession)
    rows = chunks.select("id", "source", "day", "text").where("id is not null and trim(source) <> ''").mapInArrow(_per_chunk, "id bigint, source string, day date, cluster bigint, keys array<bigint>")
    once = rows.dropDuplicates(["id", "source"])
    if about is not None:
        other = about.select("id", F.col("cluster").alias("c"), F.col("day").alias("d"))
        once = once.join(other, "id", "left").withColumn("cluster", F.coalesce("c", "cluster")).withColumn("day", F.coalesce("d", "day")).drop("c", "d")
    copies = staged(collapsed(once), "copies")
    totals = copies.groupBy("source").agg(F.sum("n").alias("n_source"))
    each = copies.select("source", "cluster", "n", "first_day", "last_day", F.explode("keys").alias("key"))
    if about is not None:  # a cluster's lines are those of any of its members: lightly edited copies differ in some
        each = each.groupBy("source", "key", "cluster").agg(F.sum("n").alias("n"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    first = F.min("first_day").alias("first_day")
    lines = each.groupBy("source", "key").agg(F.sum("n").alias("n_chunks"), F.count("*").alias("n_clusters"), first, F.max("last_day").alias("last_day"))
    lines = lines.select("source", "key", "n_chunks", "n_clusters", (F.coalesce((F.col("last_day") > F.col("first_day")).cast("int"), F.lit(0)) + 1).alias("n_days"))
    return staged(lines.where(F.col("n_chunks") >= least_chunks).join(totals, "source").where(F.col("n_chunks") >= F.col("n_source") * share), "repeated")


def boilerplate(lines: DataFrame) -> DataFrame:
    """repeated_lines with `boilerplate`: in several clusters, published on several dates (n_days counts them up to two)."""
    return lines.withColumn("boilerplate", (F.col("n_clusters") >= LEAST_CLUSTERS) & (F.col("n_days") >= LEAST_DAYS))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), F.col("source_name").alias("source"), F.to_date("extracted_at").alias("day"), "text")


def places(chunks: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, line_no) of each place of the repeated lines."""
    rows = chunks.select("id", "source", "text").where("id is not null and trim(source) <> '' and text is not null").mapInArrow(_each_line, "id bigint, source string, line_no bigint, key bigint")
    return rows.join(lines.select("source", "key"), ["source", "key"]).select("id", "line_no").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = _chunks(spark, sf_dir)
    return places(chunks, repeated_lines(chunks)).select(F.col("id").alias("chunk_id"), "line_no")


def _boilerplate(spark: SparkSession, sf_dir: str, chunks: DataFrame) -> DataFrame:
    """The repeated lines, over clusters of near-duplicates and the dates at which their files were published."""
    form = lambda c: F.coalesce(F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"), F.try_to_date(F.substring(c, 1, 8), "yyyyMMdd"))
    dates = table(spark, sf_dir, "sources").where("source_id is not null").groupBy("source_id").agg(F.min(form(F.col("date_created"))).alias("day"))
    files = table(spark, sf_dir, "chunks").where("chunk_id is not null").groupBy(F.col("chunk_id").alias("id")).agg(F.min("source_id").alias("source_id"))
    days = files.join(small(staged(dates, "dates"), BROADCAST_ROWS), "source_id").select("id", "day")
    about = near_clusters(chunks).join(days, "id", "full").select("id", "cluster", "day")
    return boilerplate(repeated_lines(chunks, about=about))


def p6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated lines of each source; boilerplate where several clusters published on several dates have it, else lines
    of a republished text."""
    r = _boilerplate(spark, sf_dir, _chunks(spark, sf_dir))
    return r.select(F.col("source").alias("source_name"), "key", "n_chunks", "n_clusters", "n_days", "n_source", "boilerplate")


def p6_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk once, its text without the boilerplate lines of its source."""
    chunks = _chunks(spark, sf_dir)
    drop = places(chunks, _boilerplate(spark, sf_dir, chunks).where("boilerplate")).groupBy("id").agg(F.collect_set("line_no").alias("drop"))
    kept = F.expr("array_join(transform(filter(transform(split(text, '\\n'), (x, i) -> struct(x as x, bigint(i) as i)), s -> not array_contains(drop, s.i)), s -> s.x), '\\n')")
    return chunks.select("id", "text").dropDuplicates(["id"]).join(drop, "id", "left").select(F.col("id").alias("chunk_id"), F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("text"), F.coalesce(F.size("drop"), F.lit(0)).alias("n_dropped"))


QUERIES = {"p6_found": p6_found, "p6_lines": p6_lines, "p6_clean": p6_clean}
SQL: dict[str, str] = {}
