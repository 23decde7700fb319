"""Encoding of a corpus with a public tokenizer, with reuse of content-defined chunks.

A rolling hash sets chunk boundaries by content, so that equal passages of different texts give equal chunks. Chunks are
counted over the whole corpus by their hashes alone; each chunk that stands in several places is encoded once and its ids
are spliced into all texts that have it. Joins are repaired: around a join the stretch between the last and the first place
where the tokenizer must divide is encoded anew, and grows over whole chunks until both sides agree with what their chunks
gave. Texts without a shared chunk are encoded as they are and never leave their partition.
"""

from __future__ import annotations

import base64
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import kernels as K
from pagemill.runtime import prepare, small, staged, table

TOKENIZERS = os.environ.get("PAGEMILL_TOKENIZERS", "/opt/tokenizers")
#: Characters the rolling hash sees, one boundary in how many possible places (a power of two), texts encoded at a time.
WINDOW, PLACES, ROWS = 16, 64, 1000
#: Rows of a staged table that may be broadcast: hashes of shared chunks, ids of the texts that have them (under 50 MB).
BROADCAST_ROWS = 1_000_000

# Fixed value: the public pattern of byte-level BPE pre-tokenization.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Places where every pre-token ends: a blank between two characters that aren't one; a letter or digit before a stop.
_SAFE = re.compile(r"(?<=\S) (?=\S)|(?<=[A-Za-z0-9ぁ-ゖァ-ヺ一-鿿])(?=[。、，．！？：；.,!?:;])")
_engines: dict = {}
#: A chunk's text and ids, its first safe place and the number of tokens before it, its last one and that number; -1: none.
Chunk = tuple[str, np.ndarray, int, int, int, int]


class Engine:
    """A byte-level BPE by its rank file, and the byte lengths of its tokens."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(os.path.basename(path), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.lengths[i] = len(token)

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, disallowed_special=()).astype(np.int32)

    def chunk(self, text: str) -> Chunk:
        ids = self.encode(text)
        at = [m.start() for m in _SAFE.finditer(text)]
        if not at:
            return text, ids, -1, 0, -1, 0
        ends = np.cumsum(self.lengths[ids])
        n = [int(np.searchsorted(ends, len(text[:x].encode("utf-8", "surrogatepass")))) + 1 if x else 0 for x in (at[0], at[-1])]
        return text, ids, at[0], n[0], at[-1], n[1]

    def joined(self, chunks: list[Chunk]) -> np.ndarray:
        """The ids of the text that the chunks make up."""
        if len(chunks) == 1:
            return chunks[0][1]
        out: list[np.ndarray] = []
        open_text = ""  # from the last safe place on
        for text, ids, q, n_q, p, n_p in chunks:
            if q < 0:  # nowhere to agree: the stretch grows over this chunk
                open_text += text
                continue
            if not out and not open_text:
                out.append(ids[:n_p])
            else:
                out += [self.encode(open_text + text[:q]), ids[n_q:n_p]]
            open_text = text[p:]
        return np.concatenate([*out, self.encode(open_text)] if open_text else out)


def engine(path: str) -> Engine:
    if path not in _engines:
        _engines[path] = Engine(path)
    return _engines[path]


def boundaries(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The content-defined chunks of all texts: text, start and end in its characters, hash. Boundaries may be before a
    blank, or after a Japanese character, where the hash of the last WINDOW characters says so."""
    a, sep = K.code_points(texts, lower=False)
    first = np.r_[0, sep[:-1] + 1]
    i = np.flatnonzero((a == 32) | (a >= 0x3041) & (a <= 0x9FFF))
    i = i[i >= WINDOW]
    doc = np.searchsorted(sep, i)
    i = i[i - first[doc] >= WINDOW]
    cut = i[(K.range_hashes(a, i - WINDOW, i) & np.uint64(PLACES - 1)) == 0]
    starts = np.sort(np.r_[first[sep > first], cut])
    doc = np.searchsorted(sep, starts)
    ends = np.minimum(np.r_[starts[1:], len(a)], sep[doc])
    return doc, starts - first[doc], ends - first[doc], K.range_hashes(a, starts, ends)


def _chunk_rows(batches):
    for batch in batches:
        if batch.num_rows:
            doc, start, end, h = boundaries([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(h.view(np.int64))], names=["id", "start", "end", "h"])


def _lists(ids: list[np.ndarray]) -> pa.Array:
    off = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))


CHUNK = "h bigint, chunk string, ids array<int>, q int, n_q int, p int, n_p int"


def encoded(texts: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> DataFrame:
    """(id, ids): the token ids of each text, without special tokens (their strings count as ordinary text).

    Null and empty texts have an empty list. Rows are kept one for one, with null or repeated ids too; extra columns are
    dropped; an empty table gives an empty result. What is shuffled are hashes of chunks, the chunks in several places and
    the texts that have one.
    """
    prepare(texts.sparkSession)
    path = f"{folder}/{tokenizer}.tiktoken"
    texts = texts.select("id", "text")

    def direct(batches):
        e = engine(path)
        for whole in batches:
            for s in range(0, whole.num_rows, ROWS):
                batch = whole.slice(s, ROWS)
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists([e.encode(t or "") for t in batch.column(1).to_pylist()])], names=["id", "ids"])

    def once(batches):
        e = engine(path)
        for batch in batches:
            rows = [(u["h"], *e.chunk(t[u["start"] : u["end"]])) for t, uses in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for u in uses if u["first"]]
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = (pa.int64(), pa.string(), None, pa.int32(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([_lists(list(c)) if t is None else pa.array(c, t) for c, t in zip(cols, kinds)], names=["h", "chunk", "ids", "q", "n_q", "p", "n_p"])

    def splice(batches):
        e = engine(path)
        for whole in batches:
            for s in range(0, whole.num_rows, ROWS):
                batch = whole.slice(s, ROWS)
                out = []
                for t, parts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                    chunks, at = [], 0
                    for u in sorted(parts or (), key=lambda u: u["start"]):
                        # another text under the same id, or another chunk under the same hash, isn't reused
                        if u["start"] >= at and t[u["start"] : u["end"]] == u["chunk"]:
                            if u["start"] > at:
                                chunks.append(e.chunk(t[at : u["start"]]))
                            chunks.append((u["chunk"], np.array(u["ids"], np.int32), u["q"], u["n_q"], u["p"], u["n_p"]))
                            at = u["end"]
                    if at < len(t):
                        chunks.append(e.chunk(t[at:]) if chunks else (t, e.encode(t), -1, 0, -1, 0))
                    out.append(e.joined(chunks))
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(out)], names=["id", "ids"])

    rows = staged(texts.where("id is not null and text <> ''").mapInArrow(_chunk_rows, "id bigint, `start` int, `end` int, h bigint"), "chunks")
    shared = staged(rows.groupBy("h").agg(F.count("*").alias("n"), F.min(F.struct("id", "start")).alias("place")).where("n > 1").select("h", "place"), "shared")
    uses = rows.join(small(shared, BROADCAST_ROWS), "h").select("id", F.struct("start", "end", "h", (F.struct("id", "start") == F.col("place")).alias("first")).alias("use"))
    uses = staged(uses.groupBy("id").agg(F.collect_list("use").alias("uses")), "uses")
    having = small(uses.select("id"), BROADCAST_ROWS)
    plain = texts.join(having, "id", "left_anti").mapInArrow(direct, "id bigint, ids array<int>")
    held = staged(texts.where("text <> ''").join(having, "id", "left_semi").join(uses, "id"), "held")
    chunks = staged(held.select("text", "uses").mapInArrow(once, CHUNK).dropDuplicates(["h"]), "encoded")
    parts = held.select("id", F.explode("uses").alias("u")).select("id", F.col("u.start").alias("start"), F.col("u.end").alias("end"), F.col("u.h").alias("h")).distinct().join(chunks, "h")
    parts = parts.groupBy("id").agg(F.collect_list(F.struct("start", "end", "chunk", "ids", "q", "n_q", "p", "n_p")).alias("parts"))
    spliced = held.select("id", "text").join(parts, "id", "left").select("id", "text", "parts").mapInArrow(splice, "id bigint, ids array<int>")
    none = texts.where("text = '' or text is null").join(having, "id", "left_semi").select("id", F.array().cast("array<int>").alias("ids"))
    return plain.union(spliced).union(none)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")).select(F.col("id").alias("doc_id"), "ids")


QUERIES = {"p8_ids": p8_ids}
SQL: dict[str, str] = {}
