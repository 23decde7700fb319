"""Filling containers of fixed capacity: minimum bin slack over lengths.

Items of one length are alike, so packing needs the numbers of items by length only: a table no longer than the capacity,
however many items there are. Each pattern takes the longest length left and fills the window that remains by a bitset
subset-sum over the multiset of lengths left, as close to the capacity as it can be, with the counts traced back; the
pattern is then used as often as its lengths last. Items meet their places by rank within their length; hot lengths are
ranked in buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagemill.llm.tokens import TOKENIZERS, encoded
from pagemill.runtime import prepare, staged, table

BUCKETS = 128


def fill(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, count) of a sub-multiset whose sum is the closest to room without passing it."""
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    full = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for n in lengths:
        before = reach
        left, part = min(counts[n], room // n), 1
        while left:
            take = min(part, left)
            reach |= (reach << (take * n)) & full
            left -= take
            part *= 2
        steps.append((n, before))
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, []
    for n, before in reversed(steps):
        k = 0
        while not before >> at & 1:
            at -= n
            k += 1
        if k:
            out.append((n, k))
    return out


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(uses, [(length, count)]) that place every item of the lengths 1 to capacity."""
    counts = {n: c for n, c in counts.items() if c > 0}
    out = []
    while counts:
        top = max(counts)
        counts[top] -= 1
        used = dict(fill(counts, capacity - top))
        counts[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(counts[n] // k for n, k in used.items())
        for n, k in used.items():
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        out.append((times, sorted(used.items(), reverse=True)))
    return out


def _numbered(df: DataFrame, by: list[str]) -> DataFrame:
    """The rows of (by, bucket, id, part) with `rank`, their number from 0 within `by`: ranks within a bucket and the
    counts of the buckets before it, so that no group is sorted in one task."""
    n = df.groupBy(*by, "bucket").agg(F.count("*").alias("n"))
    ahead = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = n.withColumn("base", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n")
    ranked = df.withColumn("r", F.row_number().over(W.partitionBy(*by, "bucket").orderBy("id", "part")) - 1)
    return ranked.join(base, [*by, "bucket"]).withColumn("rank", F.col("r") + F.col("base")).drop("r", "base")


PLACED = "limit_id int, container bigint, id bigint, part int, size int"


def _place(slots: list[tuple]):
    """The container of each (limit_id, size, rank, id, part): the slot of its length that its rank falls in, by binary
    search over the slots in the order of limit, length and first rank."""
    table = np.array(sorted(slots), np.int64).reshape(-1, 6)
    groups, first = np.unique(table[:, 0] << 32 | table[:, 1], return_index=True)
    last = np.r_[first[1:], len(table)]

    def of(batches):
        for batch in batches:
            limit, size, rank = (batch.column(c).to_numpy().astype(np.int64) for c in range(3))
            key, at = limit << 32 | size, np.zeros(batch.num_rows, np.int64)
            for g in np.unique(key):
                k, rows = np.searchsorted(groups, g), np.flatnonzero(key == g)
                at[rows] = first[k] + np.searchsorted(table[first[k] : last[k], 2], rank[rows], side="right") - 1
            container = table[at, 5] + (rank - table[at, 2]) // table[at, 4]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(container), batch.column(3), batch.column(4), batch.column(1)], names=["limit_id", "container", "id", "part", "size"])

    return of


def packed(items: DataFrame, limits: dict[int, int]) -> DataFrame:
    """(limit_id, container, id, part, size): the container of every part of every item (id, size), for each capacity.

    An item larger than a capacity is divided: full parts have containers of their own, numbered downwards from -1, the
    rest is an item. Items with a null or no size are left out; equal ids are items of their own only if they differ in
    size, so ids should be unique. An empty table gives an empty result; extra columns are dropped.
    """
    spark = prepare(items.sparkSession)
    lim = spark.createDataFrame([(k, v) for k, v in limits.items()], "limit_id int, capacity int")
    # the capacities are the caller's few
    pieces = items.where("id is not null and size > 0").select("id", "size").crossJoin(F.broadcast(lim)).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int"))
    full = pieces.where("size >= capacity").select("limit_id", "id", "bucket", F.explode(F.expr("sequence(0, int(size div capacity) - 1)")).alias("part"), F.col("capacity").alias("size"))
    rest = pieces.where("size % capacity > 0").select("limit_id", "id", "bucket", F.expr("int(size div capacity)").alias("part"), F.expr("int(size % capacity)").alias("size"))
    full, rest = staged(full, "full"), staged(rest, "rest")
    slots = []
    for limit_id, capacity in limits.items():
        # at most one row a length
        counts = {r["size"]: r["n"] for r in rest.where(F.col("limit_id") == limit_id).groupBy("size").agg(F.count("*").alias("n")).collect()}
        placed: dict[int, int] = {}
        container = 0
        for times, used in patterns(counts, capacity):
            for n, k in used:
                slots.append((limit_id, n, placed.get(n, 0), placed.get(n, 0) + k * times, k, container))
                placed[n] = placed.get(n, 0) + k * times
            container += times
    # the slots are at most as many as lengths times patterns of a capacity, whatever the number of items
    ranked = _numbered(rest, ["limit_id", "size"]).select("limit_id", "size", "rank", "id", "part")
    alone = _numbered(full, ["limit_id"]).withColumn("container", -1 - F.col("rank"))
    return ranked.mapInArrow(_place(slots), PLACED).unionByName(alone.select("limit_id", "container", "id", "part", "size"))


def _sizes(spark: SparkSession, sf_dir: str, tokenizer: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return staged(encoded(docs, tokenizer, TOKENIZERS).select("id", F.size("ids").alias("size")), "sizes")


def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = table(spark, sf_dir, "pack_limits").where("tokenizer is not null and capacity > 0").collect()  # a fixed table
    out = None
    for name in sorted({r["tokenizer"] for r in limits}):
        got = packed(_sizes(spark, sf_dir, name), {r["limit_id"]: r["capacity"] for r in limits if r["tokenizer"] == name})
        out = got if out is None else out.union(got)
    return out


def p9_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers below 0 hold one full part of a larger document each."""
    return _run(spark, sf_dir).select("limit_id", "container", F.col("id").alias("doc_id"), "part", F.col("size").alias("tokens"))


def p9_waste(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, tokens and the share of room left over, by limit."""
    cap = table(spark, sf_dir, "pack_limits").select("limit_id", "capacity")
    per = _run(spark, sf_dir).groupBy("limit_id").agg(F.countDistinct("container").alias("n_containers"), F.sum("size").alias("tokens"))
    return per.join(cap, "limit_id").select("limit_id", "n_containers", "tokens", F.round(1 - F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("waste"))


QUERIES = {"p9_packed": p9_packed, "p9_waste": p9_waste}
SQL: dict[str, str] = {}
