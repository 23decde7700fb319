import json
import random

import duckdb
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pagemill.functions import text as T
from pagemill.operators import evaluate, graph, nested, ordered, relational, retrieve
from pagemill.plans.pipeline import Ingest
from pagemill.sources import files as S
from pagemill.streaming import windows

SUB = "struct<content array<string>, bbox array<array<double>>, type array<string>>"
SCHEMA = f"record_id bigint, content_metadata struct<type string, hierarchy struct<page int, nearby_objects struct<text {SUB}, images {SUB}, structured {SUB}>>>, raw_metadata string, extra string"


def test_nested_forms(spark):
    native = ("a", (1, ((["x", None, "z"], [[0.0, 0.0, 1.0]], None), None, (None, [[1.0, 2.0, 3.0, 4.0]], ["table", None]))))
    raw = json.dumps({"metadata": {"content_metadata": {"hierarchy": {"nearby_objects": {"text": "one", "images": [{"content": "i"}, None, {"bbox": {"x0": 1, "y0": 2}}], "structured": {"content": "only", "bbox": []}}}}}})
    rows = [(1, native, None, "e"), (1, native, None, "e"), (2, None, raw, None), (3, None, raw[:40], None), (4, None, None, None), (None, native, None, None), (5, None, json.dumps([json.dumps({"hierarchy": None})]), None), (6, None, json.dumps([raw]), None)]
    got = {tuple(r) for r in nested.nearby_objects(spark.createDataFrame(rows, SCHEMA)).select("record_id", "family", "pos").collect()}
    two = {("text", 0), ("images", 0), ("images", 2), ("structured", 0)}
    assert got == {(1, "text", 0), (1, "text", 2), (1, "structured", 0)} | {(k, *x) for k in (2, 6) for x in two}
    assert nested.nearby_objects(spark.createDataFrame([], SCHEMA)).count() == 0
    values = {(r["record_id"], r["family"], r["pos"]): (r["content"], r["bbox"], r["type"]) for r in nested.nearby_objects(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert values[1, "text", 0] == ("x", [0.0, 0.0, 1.0], None) and values[1, "structured", 0] == (None, [1.0, 2.0, 3.0, 4.0], "table")
    assert values[2, "text", 0] == ("one", None, None) and values[2, "images", 2] == (None, [1.0, 2.0], None) and values[6, "structured", 0] == ("only", None, None)


def test_nested_last_received(spark):
    one = lambda text, box: json.dumps({"hierarchy": {"nearby_objects": {"text": {"content": text, "bbox": box}}}})
    rows = [(1, None, one(["a", "b"], None), "2020-01-02"), (1, None, one(["c"], [0, 0, 1, 2]), "2020-01-03"), (1, None, one(["d"], None), None)]
    df = spark.createDataFrame(rows, f"{SCHEMA.replace('extra string', 'received_at string')}")
    assert [tuple(r) for r in nested.nearby_objects(df).collect()] == [(1, "text", 0, "c", [0.0, 0.0, 1.0, 2.0], None)]


def test_nested_brute_force(spark, sf):
    truth = set()
    for r in spark.read.parquet(f"{sf}/extractions.parquet").collect():
        o = r["content_metadata"].asDict(True) if r["content_metadata"] else None
        if o is None and r["raw_metadata"]:
            try:
                o = json.loads(r["raw_metadata"])
            except ValueError:
                continue
            o = o.get("metadata", o)
            o = o.get("content_metadata", o)
        near = ((o or {}).get("hierarchy") or {}).get("nearby_objects") or {}
        for f, v in near.items():
            if isinstance(v, list):
                truth |= {(r["record_id"], f, i) for i, x in enumerate(v) if x and any(y is not None for y in x.values())}
            elif v:
                parts = [x if isinstance(x, list) else [x] for x in v.values() if x is not None]
                truth |= {(r["record_id"], f, i) for x in parts for i, y in enumerate(x) if y is not None}
    assert {tuple(r) for r in nested.p3_found(spark, sf).collect()} == truth
    last = {}
    for r in spark.read.parquet(f"{sf}/extractions.parquet").collect():
        if r["record_id"] not in last or r["received_at"] > last[r["record_id"]]["received_at"]:
            last[r["record_id"]] = r
    got = nested.p3_records(spark, sf).collect()
    assert len(got) == len(last) and all(r["received_at"] == last[r["record_id"]]["received_at"] for r in got)
    for r in got:
        c = last[r["record_id"]]["content_metadata"]
        if c is not None:
            assert (r["type"], r["page_number"], r["page"]) == (c["type"], c["page_number"], c["hierarchy"] and c["hierarchy"]["page"])


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(5, 5), (None, 3)]
    parent = list(range(200))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    ends = {x for e in edges if None not in e for x in e}
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in ends}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_put_errors_and_order(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert {tuple(r) for r in relational.put(t, spark.createDataFrame([(2, "x")], "id int, v string"), "id").collect()} == {(1, "a"), (2, "x")}
    assert {tuple(r) for r in relational.put(t, spark.createDataFrame([(2, None)], "id int, v string"), "id").collect()} == {(1, "a"), (2, None)}
    for bad in ([(3, "x")], [(1, "x"), (1, "y")], [(None, "x")]):
        with pytest.raises(PySparkException):
            relational.put(t, spark.createDataFrame(bad, "id int, v string"), "id").collect()


def test_answer_scores(spark):
    rows = [("Don't use the 16.00% of 1,000, a 205.60!", "dont use 16 of 1000 205.6"), ("<think>x</think>cat", "The cat"), ("<think>open", ""), ("", "x"), (None, None), ("the the cat cat", "cat")]
    got = [r["t"] for r in spark.createDataFrame(rows, "a string, r string").select(T.token_scores(F.col("a"), F.col("r")).alias("t")).collect()]
    assert [(t["exact_match"], t["f1"]) for t in got] == [(True, 1.0), (True, 1.0), (True, 1.0), (False, 0.0), (True, 1.0), (False, 0.6667)]
    words = spark.createDataFrame([("alpha alpha beta gamma", "alpha"), ("of the", ""), ("alpha beta gamma", "alpha")], "a string, c string")
    assert [r[0] for r in words.select(T.answer_in_context(F.col("a"), F.col("c"))).collect()] == [True, True, False]
    cases = [(True, 0.9, None, "x", "correct"), (True, None, None, "x", "judge_error"), (True, None, "thinking_truncated", "", "thinking_truncated"), (False, 0.5, None, "It is not mentioned.", "refused_missing_context"), (True, 0.0, None, "no information", "refused_with_context"), (True, 0.3, None, "x", "partial"), (True, 0.0, None, None, "generation_miss"), (False, 0.0, None, "x", "retrieval_miss")]
    df = spark.createDataFrame(cases, "ok boolean, s double, e string, a string, want string")
    assert all(r[0] == r[1] for r in df.select(T.failure_mode(F.col("ok"), F.col("s"), F.col("e"), F.col("a")), "want").collect())


def test_answer_in_context_normalises_each_text_once(spark):
    many = " ".join(f"Word{i}" for i in range(1_000))
    rows = [(many, many, True), (many, many[: len(many) // 3], False), ("of the", None, True), ("alpha", None, False), (None, "alpha", None), ("alpha\u00a0beta\x1cgamma", "ALPHA", True), ("1,000.50 alpha beta", "1000.5", False)]
    df = spark.createDataFrame(rows, "a string, c string, want boolean").select("want", T.answer_in_context(F.col("a"), F.col("c")).alias("ok"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count(T.BLANKS) == 2
    assert all(r["ok"] == r["want"] for r in df.collect())


def test_failure_modes_compare_texts_only_where_they_decide(spark, tmp_path):
    many = " ".join(f"Word{i}" for i in range(1_000))
    answers = [many, "Word1 elsewhere nowhere", "It is NOT mentioned.", "not mentioned Word1 Word2 Word3", "of the"]
    rows = [(a, s, e) for a in answers for s in (None, float("nan"), 0.0, 0.24, 0.25, 0.74, 0.75, 1.0) for e in (None, "blurred", "thinking_truncated")]
    spark.createDataFrame([(i, i % 3, a, f"m{i % 2}", s, e) for i, (a, s, e) in enumerate(rows)], "observation_id long, chunk_id long, text string, model string, score double, error string").write.parquet(str(tmp_path / "observations.parquet"))
    spark.createDataFrame([(0, many), (1, "Word1 Word2 Word3 mentioned"), (2, "other words")], "chunk_id long, text string").write.parquet(str(tmp_path / "chunks.parquet"))
    df = evaluate.failure_mode_breakdown(spark, str(tmp_path))
    assert df._jdf.queryExecution().optimizedPlan().toString().count(T.BLANKS) == 2
    con = duckdb.connect()
    for t in ("observations", "chunks"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    want = {tuple(r) for r in con.execute(evaluate.SQL["failure_mode_breakdown"]).fetchall()}
    assert {(r["model"], r["mode"], r["n"]) for r in df.collect()} == want and len({r[1] for r in want}) == 8
    cases = spark.createDataFrame(rows, "a string, s double, e string")
    mode = lambda ok: T.failure_mode(F.lit(ok), F.col("s"), F.col("e"), F.col("a"))
    assert all(r["needed"] == r["differs"] for r in cases.select(F.coalesce(T.by_context(F.col("s"), F.col("e"), F.col("a")), F.lit(False)).alias("needed"), (mode(True) != mode(False)).alias("differs")).collect())


def test_runs_and_windows(spark):
    df = spark.createDataFrame([("s", 100.0, 102.0), ("s", 102.0, 104.0), ("s", 104.0, 106.0), ("s", 120.0, 121.0)], "k string, a double, b double")
    got = ordered.merge_runs(df, ["k"], "a", "b", 1.0).orderBy("run_start").collect()
    assert [(r["run_start"], r["run_end"], r["mid"], r["n"]) for r in got] == [(100.0, 106.0, 103.0, 3), (120.0, 121.0, 120.5, 1)]
    texts = spark.createDataFrame([("a b c d e",), ("",), ("a b",)], "t string")
    assert [r[0] for r in texts.select(ordered.token_windows(F.col("t"), 3, 1)).collect()] == [["a b c", "c d e"], [], ["a b"]]
    with pytest.raises(ValueError):
        ordered.token_windows(F.col("t"), 0, 0)


def test_rrf(spark):
    rows = [("q1", 0, "d1", 1), ("q1", 0, "d2", 2), ("q1", 1, "d1", 1), ("q1", 1, "d3", 2), ("q2", 0, "d4", 1), ("q2", 0, "d5", 2)]
    got = {(r["query_id"], r["doc_id"]): (r["score"], r["final_rank"]) for r in retrieve.fuse(spark.createDataFrame(rows, "query_id string, step int, doc_id string, rank int")).collect()}
    assert got["q1", "d1"] == (round(2 / 61, 8), 1) and got["q1", "d2"][1] == 2 and got["q2", "d5"][1] == 2


def test_sources(spark, tmp_path):
    assert S.csv_table(b"name;photo;value\nA;data:image/png;base64,AAA;1\nB;;2\n")[0] == ["name", "photo", "value"]
    assert S.html_text("<p>a &amp; b</p><script>x</script><div> c </div>") == "a & b\n\nc"
    assert S.html_text("a<template>x<template>y</template>z</template>b<!-- c --><style>p > q</style>d &lt;e&gt; <img alt='>'/>f") == "a\n\nb\n\nd <e>\n\nf"
    assert S.html_text("shown<noscript>no <b>yes</b>") == "shown" and S.html_text("x<script>if (a<b) y('</p>')</script>z</p>") == "x\n\nz"
    (tmp_path / "a.txt").write_text("one two three four")
    (tmp_path / "b.html").write_text("<b>five</b> six")
    (tmp_path / "c.csv").write_text("h,k\n1,2\n")
    (tmp_path / "d.xyz").write_text("?")
    run = Ingest(spark).files([f"{tmp_path}/*.txt", f"{tmp_path}/*.html", f"{tmp_path}/*.csv"]).split(3).embed(lambda c: F.array(F.length(c).cast("double")))
    counters = run.write(f"{tmp_path}/out", dim=1).first()
    assert counters["written"] == 7 and counters["dropped_no_text"] == 0
    with pytest.raises(FileNotFoundError):
        S.expand_paths([f"{tmp_path}/none.txt"])
    assert S.expand_paths([f"{tmp_path}/*.none"]) == []
    with pytest.raises(IsADirectoryError):
        S.expand_paths([str(tmp_path)])
    with pytest.raises(PySparkException):
        Ingest(spark).files([f"{tmp_path}/*.*"]).df.collect()


def test_tokenizer_windows(spark):
    path = "/opt/tokenizers/byte_bpe_50k.json"
    df = spark.createDataFrame([(1, "One two  three, four five.\nSix"), (2, None), (3, "  "), (4, "word")], "id int, text string")
    got = ordered.tokenizer_windows(df, path, 4).collect()
    assert [r["text"] for r in got if r["id"] == 4] == ["word"] and {r["id"] for r in got} == {1, 4}
    one = [r["text"] for r in sorted(got, key=lambda r: r["chunk_index"]) if r["id"] == 1]
    assert len(one) > 1 and "".join(one) == "One two  three, four five.\nSix" and all(r["chunk_count"] == len(one) for r in got if r["id"] == 1)
    with pytest.raises(ValueError):
        ordered.tokenizer_windows(df, path, 0)


def test_fused_ties_and_cut(spark):
    audio = spark.createDataFrame([(1, "s", 0.0, 2.0, " said "), (2, "s", 50.0, 51.0, "alone"), (3, "s", 0.0, 1.0, " ")], "id int, k string, start double, end double, text string")
    frames = spark.createDataFrame([(7, "s", 0.0, 2.0, "short"), (8, "s", 0.5, 1.5, "y" * 99 + " " + "z" * 50), (9, "s", 2.0, 9.0, "far")], "id int, k string, start double, end double, text string")
    got = {r["id"]: (r["text"], r["modality"], r["n_frames"]) for r in ordered.fused(audio, frames, "k", 5.0).collect()}
    assert got == {1: ("[AUDIO] said | [VISUAL] " + "y" * 99, "audio_visual", 3), 2: ("alone", "audio", 0), 3: (" ", "audio", 0)}


def test_stream(spark, sf, tmp_path):
    e = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    e.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(e.schema).parquet(f"{tmp_path}/in")
    q = windows.tumbling(stream, "1 hour", "10 minutes").writeStream.outputMode("complete").format("memory").queryName("tumbled").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("tumbled").count() == windows.tumbling(e).count()


def test_knn_in_blocks(spark, monkeypatch):
    rows = [(i, [float(i * i % 17), float(i)]) for i in range(10)]
    v = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = {tuple(r) for r in retrieve.knn(v, v, 2).collect()}
    assert len(whole) == 20
    for block in (3, 5):
        monkeypatch.setattr(retrieve, "QUERY_BLOCK", block)
        assert {tuple(r) for r in retrieve.knn(v, v, 2).collect()} == whole


def test_files_without_a_reader_are_not_lost(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one two")
    (tmp_path / "b.pdf").write_bytes(b"%PDF")
    (tmp_path / "c.odd").write_bytes(b"?")
    with pytest.raises(PySparkException, match="unsupported file"):
        Ingest(spark).files([f"{tmp_path}/a.txt", f"{tmp_path}/b.pdf"]).df.collect()
    got = Ingest(spark).files([f"{tmp_path}/*"], strict=False).df.collect()
    assert sorted((r["path"][-5:], r["text"], r["error"]) for r in got) == [("a.txt", "one two", None), ("b.pdf", None, "no reader: pdf"), ("c.odd", None, "no reader: unknown family")]
