"""Near-duplicate texts: one-permutation hashing with optimal densification, banded buckets, star-shaped candidate edges.

Texts are sets of `k` consecutive words. Each text gets a signature of minima over the bins of one permutation; bands of
the signature are bucket keys. A bucket of n texts gives n - 1 edges to one centre, never its pairs: first within each
input batch (so a bucket that holds a third of all rows leaves the map side as one row a batch), then over the batches.
Edges are kept where a one-byte sketch of the signature agrees often enough. Small components of what is left are compared
all against all; in larger ones only texts that share a bucket are, by their sketches first, in blocks of bounded size, so
that a template which chains a component together doesn't make it quadratic. Exact copies are one class throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import kernels as K
from pagemill.operators.graph import components
from pagemill.runtime import prepare, small, staged, table

#: With 24 bands of 3 rows a pair at a Jaccard similarity of 0.6 meets in some band with probability 0.997; members of one
#: small component are all compared afterwards.
BANDS, ROWS, SKETCH = 24, 3, 64
#: Standard deviations of the signature agreement, under the lowest similarity of a true pair, below which an edge is dropped.
DEVIATIONS = 2.8
#: Texts of a component that are compared all against all, and of a block beyond that.
BLOCK = 1024
#: Rows of a staged key table that may be broadcast (under 20 MB); beyond it the join shuffles.
BROADCAST_ROWS = 600_000


def _nodes(w: np.ndarray, wd: np.ndarray, n: int) -> np.ndarray:
    """A hash of the words of each of n texts in their order."""
    first = np.searchsorted(wd, np.arange(n))
    place = np.arange(len(w), dtype=np.uint64) - first[wd].astype(np.uint64)
    node = np.zeros(n, np.uint64)
    np.add.at(node, wd, K.mix(w + place * np.uint64(0x9E3779B97F4A7C15)))
    return node


def word_nodes(chunks: DataFrame) -> DataFrame:
    """(id, node) of each text with a word, by the nodes of `signatures`."""

    def of(batches):
        for batch in batches:
            n = batch.num_rows
            w, wd = K.word_hashes(batch.column(1).to_pylist())
            if len(w):
                at = np.flatnonzero(np.bincount(wd, minlength=n))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(_nodes(w, wd, n)[at].view(np.int64))], names=["id", "node"])

    return chunks.select("id", "text").where("id is not null and text is not null").mapInArrow(of, "id bigint, node bigint")


def signatures(chunks: DataFrame, k: int, least: int) -> DataFrame:
    """(id, node, sketch, bands) of each text with at least `least` different shingles; node is a hash of its words."""

    def of(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            w, wd = K.word_hashes(texts)
            n = len(texts)
            if len(w) < k:
                continue
            h = np.zeros(len(w) - k + 1, np.uint64)
            for i in range(k):
                h = h * np.uint64(0xD6E8FEB86659FD93) + w[i : i + len(h)]
            same = wd[: len(h)] == wd[k - 1 :]
            h, doc = K.mix(h[same]), wd[: len(h)][same]
            node = _nodes(w, wd, n)
            count = np.bincount(doc, minlength=n)
            bins = BANDS * ROWS
            sig = K.one_permutation(h, doc, n, bins)
            seen = np.zeros(n * bins, bool)
            seen[doc * bins + ((((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64))] = True
            enough = seen.reshape(n, bins).sum(axis=1) >= least
            for d in np.flatnonzero(~enough & (count >= least)):
                enough[d] = len(np.unique(h[doc == d])) >= least
            at = np.flatnonzero(enough)
            if not len(at):
                continue
            bands = K.band_keys(sig[at], ROWS).view(np.int64)
            sketch = np.ascontiguousarray((sig[at][:, :SKETCH] & np.uint64(0xFF)).astype(np.uint8))
            m = len(at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[at]),
                    pa.array(node[at].view(np.int64)),
                    pa.Array.from_buffers(pa.binary(), m, [None, pa.py_buffer(np.arange(0, (m + 1) * SKETCH, SKETCH, dtype=np.int32)), pa.py_buffer(sketch.tobytes())]),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, (m + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(bands.ravel())),
                ],
                names=["id", "node", "sketch", "bands"],
            )

    return chunks.mapInArrow(of, "id bigint, node bigint, sketch binary, bands array<bigint>")


def _stars(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct (key, node): key, centre (the least node of the key) and node, sorted."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    if len(key):
        new = np.r_[True, (key[1:] != key[:-1]) | (node[1:] != node[:-1])]
        key, node = key[new], node[new]
    first = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    return key, node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))], node


def candidate_edges(docs: DataFrame) -> DataFrame:
    """Distinct star edges (a, b), a < b, of all buckets."""

    def local(batches):
        for batch in batches:
            node, bands = batch.column(0).to_numpy(), batch.column(1).flatten().to_numpy()
            key, centre, member = _stars(bands, np.repeat(node, BANDS))
            inner = centre != member
            # edges within the batch travel under keys of their own, so no bucket is gathered by its size
            key = np.where(inner, K.mix(K.mix(centre.view(np.uint64)) + member.view(np.uint64)).view(np.int64), key)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(centre), pa.array(member)], names=["key", "a", "b"])

    def across(batches):
        key, a, b = [], [], []
        for batch in batches:
            key.append(batch.column(0).to_numpy())
            a.append(batch.column(1).to_numpy())
            b.append(batch.column(2).to_numpy())
        if not key:
            return
        key, a, b = np.concatenate(key), np.concatenate(a), np.concatenate(b)
        edge = a != b
        _, centre, member = _stars(key[~edge], b[~edge])
        far = centre != member
        e = np.unique(np.stack([np.r_[a[edge], centre[far]], np.r_[b[edge], member[far]]], axis=1), axis=0)
        for s in range(0, len(e), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(e[s : s + 50_000, 0]), pa.array(e[s : s + 50_000, 1])], names=["a", "b"])

    keyed = docs.select("node", "bands").mapInArrow(local, "key bigint, a bigint, b bigint")
    return keyed.repartition("key").mapInArrow(across, "a bigint, b bigint").distinct()


def agreement(share: float, least: int) -> float:
    """The least signature agreement of an edge. Texts of few shingles fill few bins, the others repeat these."""
    return share - DEVIATIONS * (share * (1 - share) / min(SKETCH, max(least, 16))) ** 0.5


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _agreeing(edges: DataFrame, sketches: DataFrame, agree: float) -> DataFrame:
    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array((_sketches(batch.column(2)) == _sketches(batch.column(3))).mean(axis=1) >= agree)).select([0, 1])

    s = lambda end: sketches.select(F.col("node").alias(end), F.col("sketch").alias(f"sketch_{end}"))
    return edges.join(s("a"), "a").join(s("b"), "b").select("a", "b", "sketch_a", "sketch_b").mapInArrow(keep, "a bigint, b bigint")


def _in_blocks(rows: DataFrame, by: list[str]) -> DataFrame:
    """The rows once for each pair of blocks (x <= y) of their group; a group is cut into blocks by its size."""
    sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    r = rows.join(sizes, by).withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return r.withColumn("x", F.least("block", "other")).withColumn("y", F.greatest("block", "other")).drop("other", "blocks")


def _near(agree: float):
    """Of one pair of blocks of a bucket: the pairs of nodes whose sketches agree."""

    def of(t: pa.Table) -> pa.Table:
        node, block, s = t.column("node").to_numpy(), t.column("block").to_numpy(), _sketches(t.column("sketch").combine_chunks())
        i, j = [], []
        for k in range(len(node) - 1):
            rest = np.flatnonzero((s[k + 1 :] == s[k]).mean(axis=1) >= agree) + k + 1
            i.append(np.full(len(rest), k))
            j.append(rest)
        i, j = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (i, j))
        if t.column("x")[0].as_py() != t.column("y")[0].as_py():
            i, j = (v[block[i] != block[j]] for v in (i, j))
        return pa.table({"a": np.minimum(node[i], node[j]), "b": np.maximum(node[i], node[j])})

    return of


def _alike(shared: np.ndarray, a: np.ndarray, b: np.ndarray, share: float) -> np.ndarray:
    return shared >= share * (a + b - shared) - 1e-9


def _all_pairs(share: float):
    """Of one component: its alike pairs, by the shingles they share; nodes sent again count once."""

    def of(t: pa.Table) -> pa.Table:
        node, first = np.unique(t.column("node").to_numpy(), return_index=True)
        s = t.column("s").combine_chunks().take(pa.array(first))
        size, h = np.diff(s.offsets.to_numpy()), s.flatten().to_numpy()
        who = np.repeat(np.arange(len(node)), size)
        order = np.argsort(h, kind="stable")
        h, who = h[order], who[order]
        shared = np.zeros((len(node), len(node)), np.int32)
        starts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        for s0, s1 in zip(starts, np.r_[starts[1:], len(h)]):
            if s1 - s0 > 1:
                w = who[s0:s1]
                shared[np.ix_(w, w)] += 1
        i, j = np.nonzero(np.triu(shared, 1))
        c = shared[i, j].astype(np.int64)
        ok = _alike(c, size[i], size[j], share)
        i, j, c = i[ok], j[ok], c[ok]
        return pa.table({"a": node[i], "b": node[j], "shared": c, "size_a": size[i].astype(np.int64), "size_b": size[j].astype(np.int64)})

    return of


def _check(share: float):
    """Keeps the alike ones of pairs that carry both sets."""

    def of(batches):
        for batch in batches:
            sets = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(2), batch.column(3))]
            size = [np.diff(o) for o, _ in sets]
            shared = np.array([len(np.intersect1d(*(v[o[k] : o[k + 1]] for o, v in sets), assume_unique=True)) for k in range(batch.num_rows)], np.int64)
            ok = pa.array(_alike(shared, size[0], size[1], share))
            rows = [batch.column(0), batch.column(1), pa.array(shared), pa.array(size[0].astype(np.int64)), pa.array(size[1].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(rows, names=["a", "b", "shared", "size_a", "size_b"]).filter(ok)

    return of


LINKS = "a bigint, b bigint, shared bigint, size_a bigint, size_b bigint"


def similar_pairs(chunks: DataFrame, k: int = 5, least: int = 1, share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The pairs of alike texts among (id, text) rows: links (a, b, shared, size_a, size_b) between different texts, by
    node, and members (id, node) of all texts that were compared, each id once.

    Alike: the Jaccard similarity of the shingle sets is at least `share`. Null, blank and short texts (fewer than `least`
    different shingles) are no members. Repeated rows count once, equal word sequences are one node, extra columns are
    ignored, an empty table gives empty results.
    """
    prepare(chunks.sparkSession)
    agree = agreement(share, least)
    docs = staged(signatures(chunks.select("id", "text").where("id is not null and text is not null"), k, least), "signatures")
    members = docs.select("id", "node").distinct()
    sketches = docs.groupBy("node").agg(F.first("sketch").alias("sketch"))
    edges = staged(_agreeing(candidate_edges(docs), sketches, agree), "edges")
    comp = components(edges)
    sizes = comp.groupBy("component").agg(F.count("*").alias("n"))
    reps = members.groupBy("node").agg(F.min("id").alias("id"))
    comp = staged(comp.join(sizes, "component").join(reps, "node").select("id", "node", "component", "n"), "components")

    def sets(batches):
        for batch in batches:
            if batch.num_rows:
                h, off, _ = K.unique_shingles(batch.column(0).to_pylist(), k)
                s = pa.LargeListArray.from_arrays(pa.array(off.astype(np.int64)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), batch.column(3), s.cast(pa.list_(pa.int64()))], names=["node", "component", "n", "s"])

    with_text = chunks.select("id", "text").where("text is not null").join(small(comp, BROADCAST_ROWS), "id").select("text", "node", "component", "n")
    rows = with_text.mapInArrow(sets, "node bigint, component bigint, n bigint, s array<bigint>")
    links = rows.where(f"n <= {BLOCK}").select("node", "component", "s").groupBy("component").applyInArrow(_all_pairs(share), LINKS)
    large = comp.where(f"n > {BLOCK}")
    if not large.isEmpty():
        held = docs.join(large.select("node", "component"), "node").dropDuplicates(["node"]).select("component", "node", "sketch", F.explode("bands").alias("key"))
        pairs = _in_blocks(held, ["component", "key"]).groupBy("component", "key", "x", "y").applyInArrow(_near(agree), "a bigint, b bigint").distinct()
        held = staged(rows.where(f"n > {BLOCK}").dropDuplicates(["node"]).select("node", "s"), "sets")
        s = lambda end: held.select(F.col("node").alias(end), F.col("s").alias(f"s_{end}"))
        links = links.union(pairs.join(s("a"), "a").join(s("b"), "b").select("a", "b", "s_a", "s_b").mapInArrow(_check(share), LINKS))
    return links, members


def pairs_of_ids(links: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) ids, the smaller first: every copy of one text with the representative (least id) of each text it is alike
    with, and every copy with its own representative. Linear in the copies; no link between different texts is lost."""
    reps = members.groupBy("node").agg(F.min("id").alias("rep"))
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    across = both.join(members.select(F.col("node").alias("a"), "id"), "a").join(reps.select(F.col("node").alias("b"), "rep"), "b").select("id", "rep")
    copies = members.join(reps, "node").where("id <> rep").select("id", "rep")
    return across.union(copies).select(F.least("id", "rep").alias("a"), F.greatest("id", "rep").alias("b")).distinct()


#: Alike, as TESTDATA.md has it: 25 triples of words at least, and of the triples in either text 0.6 in both.
ALIKE = {"k": 3, "least": 25, "share": 0.6}


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), "text")
    links, members = similar_pairs(chunks, **ALIKE)
    return pairs_of_ids(staged(links, "links"), members).select(F.col("a").alias("chunk_a"), F.col("b").alias("chunk_b"))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each chunk in a group of alike texts (as in p4_found, and exact copies of any length): class (exact copies), group, links of its class."""
    chunks = table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), "text")
    links, members = similar_pairs(chunks, **ALIKE)
    members = staged(members.union(word_nodes(chunks).join(members, "id", "left_anti").select("id", "node").distinct()), "members")
    links = staged(links.select("a", "b"), "links")
    group = components(links).withColumnRenamed("node", "n")
    degree = links.select(F.explode(F.array("a", "b")).alias("d")).groupBy("d").agg(F.count("*").alias("n_links"))
    m = members.join(members.groupBy("node").agg(F.min("id").alias("class_id"), F.count("*").alias("n_copies")), "node")
    m = m.join(group, m.node == group.n, "left").withColumn("component", F.coalesce("component", "node"))
    lead = m.groupBy("component").agg(F.min("id").alias("group_id"), F.count("*").alias("n_group"))
    m = m.join(lead, "component").where("n_group > 1").join(degree, F.col("node") == F.col("d"), "left")
    return m.select(F.col("id").alias("chunk_id"), "class_id", "group_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))


QUERIES = {"p4_found": p4_found, "p4_groups": p4_groups}
SQL: dict[str, str] = {}
