"""The corpus operators against brute force, exact round trips and built cases."""

import base64
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.llm import cuts, kernels, languages, lines, neardup, packing, quality, scans, tokens, unify

WORDS = "the report of annual ledger was moved near northern gate before season opened and clerk measured every boundary twice because original lost in heavy rain while others waited outside".split()


def make(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def texts(spark, rows, schema="id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def test_word_hashes_match_words():
    t = ["One two, one TWO", None, "", "İstanbul ß 日本 a_b"]
    h, doc = kernels.word_hashes(t)
    assert h[0] == h[2] and h[1] == h[3] and list(doc[:4]) == [0] * 4 and set(doc) == {0, 3}


@pytest.mark.parametrize("share,block", [(0.6, 256), (0.8, 256), (0.6, 3)])
def test_near_duplicates_brute_force(spark, share, block, monkeypatch):
    """A small block makes every component a large one."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(3)
    rows = []
    for g in range(25):
        base = make(rng, 80).split()
        for v in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(v * 3):
                w[rng.randrange(len(w))] = make(rng, 1)
            rows.append(" ".join(w))
    rows += [rows[0], rows[0], None, "", "short text", rows[3]]
    data = [(i * 3, t, "x") for i, t in enumerate(rows)] + [(0, rows[0], "again")]
    k, least = 3, 25

    def sets(t):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    s = {i: sets(t) for i, t, _ in data}
    s = {i: x for i, x in s.items() if len(x) >= least}
    alike = lambda x, y: len(x & y) >= share * len(x | y)
    truth = {(a, b) for a in s for b in s if a < b and alike(s[a], s[b])}
    links, members = neardup.similar_pairs(texts(spark, data, "id bigint, text string, node string"), k, least, share)
    got = {tuple(r) for r in neardup.pairs_of_ids(links, members).collect()}
    assert got <= truth
    first = {}
    for i, t, _ in data:
        first.setdefault(t, i)
    text = {i: t for i, t, _ in data}
    apart = {p for p in truth if first[text[p[0]]] == p[0] and first[text[p[1]]] == p[1]}  # pairs of representatives
    assert len(apart & got) >= 0.98 * len(apart)
    assert (0, next(i for i, t, _ in data if t == rows[0] and i)) in got
    none, nobody = neardup.similar_pairs(texts(spark, [(1, None)]), k, least, share)
    assert none.count() == 0 and nobody.count() == 0


def test_pairs_of_all_chunks(spark, sf):
    """Recall over a whole table of pairs of different texts at the stated threshold, the union written out."""
    first = {}
    for i, t in spark.read.parquet(f"{sf}/chunks.parquet").select("chunk_id", "text").distinct().collect():
        w = tuple(re.findall(r"[^\W_]+", (t or "").lower()))
        if len({w[i : i + 3] for i in range(len(w) - 2)}) >= 25:
            first[w] = min(i, first.get(w, i))
    s = {i: {w[k : k + 3] for k in range(len(w) - 2)} for w, i in first.items()}
    truth = {(a, b) for a in s for b in s if a < b and len(s[a] & s[b]) >= 0.6 * len(s[a] | s[b])}
    got = {tuple(r) for r in neardup.p4_found(spark, sf).collect()}
    assert truth and len(truth & got) >= 0.98 * len(truth)
    assert {p for p in got if p[0] in s and p[1] in s} <= truth


def test_groups_at_the_threshold_of_the_pairs(spark, tmp_path):
    rng = random.Random(8)
    base = make(rng, 90).split()
    edited = [w if i % 20 else make(rng, 1) for i, w in enumerate(base)]  # shares over 0.8 of the triples, Jaccard of five words under 0.8
    short = make(rng, 10)
    rows = [(1, " ".join(base)), (2, " ".join(edited)), (3, make(rng, 90)), (4, make(rng, 90)), (6, short), (7, short), (8, None)]
    rows += [(5, rows[3][1]), (5, rows[3][1])]
    spark.createDataFrame(rows, "chunk_id bigint, text string").write.parquet(f"{tmp_path}/chunks.parquet")
    got = {r["chunk_id"]: (r["class_id"], r["group_id"], r["n_copies"], r["n_links"]) for r in neardup.p4_groups(spark, str(tmp_path)).collect()}
    assert got == {1: (1, 1, 1, 1), 2: (2, 1, 1, 1), 4: (4, 4, 2, 0), 5: (4, 4, 2, 0), 6: (6, 6, 2, 0), 7: (6, 6, 2, 0)}
    assert {tuple(r) for r in neardup.p4_found(spark, str(tmp_path)).collect()} == {(1, 2), (4, 5)}


def test_characters(spark):
    rows = [(1, "ｆｕｌｌ"), (2, "café"), (3, "in​visible so­ft"), (4, "a b c"), (5, "раge Тһe sсan"), (6, "ﬁsh oﬃce"), (7, "Москва und Berlin α"), (8, "日本語、です（はい）。"), (9, None), (10, ""), (1, "ｆｕｌｌ")]
    got = {tuple(r) for r in unify.disguised(texts(spark, rows)).collect()}
    assert got == {(1, "fullwidth"), (2, "decomposed"), (3, "zero_width"), (4, "odd_space"), (5, "lookalike"), (6, "ligature")}
    form = {r["id"]: r["text"] for r in unify.canonical(texts(spark, rows)).collect()}
    assert form[1] == "full" and form[2] == "café" and form[3] == "invisible soft" and form[4] == "a b c" and form[6] == "fish office"
    assert form[7] == rows[6][1] and form[8] == rows[7][1] and form[9] is None and form[10] == "" and form[5].split()[2] == "scan"


def test_scans(spark):
    page = "The clerk measured the annual report before the season opened. The report was moved near the northern gate.\n"
    rows = [(i, f"/v/annual-report-notes-{i:07d}.pdf", 3, page) for i in range(60)]
    rows += [
        (100, "/v/annual-report-notes-0000001.pdf", 7, "The annua1 rep0rt was rnoved. The cl-\nerk measured the gate.\nANNUAL REPORT NOTES\n- 7 -\nThe rep¬\nort opened."),
        (101, "/v/other-thing-here-0000002.pdf", 7, "A follow-up was moved near the follow-\nup report.\nSection 7\n8\nPage 9 of the report"),
        (102, "/v/x.pdf", None, None),
        (103, None, None, ""),
    ] + [(200 + i, "/v/z-0.pdf", 1, "The follow-up was moved.") for i in range(9)]
    got = {tuple(r) for r in scans.scan_noise(spark.createDataFrame(rows, "id bigint, path string, page int, text string")).collect()}
    assert got == {(100, k) for k in ("misread", "split_word", "running_head", "page_number")}
    assert scans.scan_noise(spark.createDataFrame([], "id bigint, path string, page int, text string")).count() == 0


def test_scans_repaired(spark):
    page = "The clerk measured the annual report before the season opened. The report was moved near the northern gate.\n"
    rows = [(i, f"/v/annual-report-notes-{i:07d}.pdf", 3, page) for i in range(60)] + [(200 + i, "/v/z-0.pdf", 1, "The follow-up was moved.") for i in range(9)]
    scan = "The annua1 rep0rt was rnoved before the season of the cl-\nerk opened. The report was moved near the northern gate of\n\nANNUAL REPORT NOTES\n\n- 7 -\n\nthe clerk. The follow-\nup report was moved.\n4nnual gate.\n\nItems moved:\n- gate\n- report"
    rows += [(100, "/v/annual-report-notes-0000001.pdf", 7, scan), (104, "/v/x.pdf", 1, "Gate\nReport\nSeason")] + [(101, "/v/x.pdf", None, None), (102, None, None, " ")]
    rows += [(103, "/v/x.pdf", 1, "gate,46.6,87,\nreport,5,,3\n,7,8,9"), (104, "/v/x.pdf", 1, "Gate\nReport\nSeason")]
    done = scans.repaired(spark.createDataFrame(rows, "id bigint, path string, page int, text string")).collect()
    got = {r["id"]: r["text"] for r in done}
    assert len(done) == len(got) == len({r[0] for r in rows})
    assert got[100] == "The annual report was moved before the season of the clerk opened. The report was moved near the northern gate of the clerk. The follow-up report was moved.\nAnnual gate.\n\nItems moved:\n- gate\n- report"
    assert got[0] == page.strip() and got[101] is None and got[102] == " " and got[103] == rows[-2][3] and got[104] == rows[-1][3]


def test_repeated_lines_brute_force(spark, sf):
    chunks = spark.read.parquet(f"{sf}/chunks.parquet").select("chunk_id", "source_name", "text").distinct().collect()
    letters = lambda x: "".join(c for c in x.lower() if c.isalpha())
    count, total = {}, {}
    for r in chunks:
        if r["source_name"] and r["source_name"].strip():
            total[r["source_name"]] = total.get(r["source_name"], 0) + 1
            for k in {letters(x) for x in (r["text"] or "").split("\n")}:
                if len(k) >= 8:
                    count[r["source_name"], k] = count.get((r["source_name"], k), 0) + 1
    bad = {k for k, n in count.items() if n >= 5 and n >= 0.05 * total[k[0]]}
    truth = {(r["chunk_id"], i) for r in chunks for i, x in enumerate((r["text"] or "").split("\n")) if (r["source_name"], letters(x)) in bad}
    assert {tuple(r) for r in lines.p6_found(spark, sf).collect()} == truth
    left = {r["chunk_id"]: r["n_dropped"] for r in lines.p6_clean(spark, sf).collect()}
    assert sum(left.values()) <= len(truth)


def test_republished_articles_are_no_boilerplate(spark, tmp_path):
    """Twelve lightly edited copies of one article share its lines; a notice stands in eight articles of several days."""
    rng = random.Random(9)
    article = [make(rng, 14) for _ in range(9)]
    rows, files = [], []
    for i in range(40):
        own = [make(rng, 12) for _ in range(8)]
        body = [*article[:8], article[8] + f" edition {i}"] if i < 12 else own
        rows.append((i, f"f{i}", "site", "\n".join(body + (["Read our legal notice here"] if 12 <= i < 20 else [])), "2024-05-05 00:00:00"))
        files.append((f"f{i}", f"2024-01-{1 + i % 9:02d}T10:00:00"))
    rows += [rows[0], (90, None, "site", None, "2024-05-05 00:00:00")]
    spark.createDataFrame(rows, "chunk_id bigint, source_id string, source_name string, text string, at string").selectExpr("*", "timestamp(at) as extracted_at").write.parquet(f"{tmp_path}/chunks.parquet")
    spark.createDataFrame(files, "source_id string, date_created string").write.parquet(f"{tmp_path}/sources.parquet")
    got = lines.p6_lines(spark, str(tmp_path)).collect()
    assert sorted((r["n_chunks"], r["n_clusters"], r["boilerplate"]) for r in got) == [(8, 8, True)] + [(12, 1, False)] * 9
    clean = {r["chunk_id"]: r for r in lines.p6_clean(spark, str(tmp_path)).collect()}
    assert len(clean) == 41 and clean[3]["text"] == rows[3][3] and clean[15]["n_dropped"] == 1 and clean[90]["text"] is None
    assert not clean[15]["text"].endswith("here")
    assert lines.p6_found(spark, str(tmp_path)).count() == 12 * 9 + 8


def test_copies_collapse_before_lines_are_counted(spark, tmp_path, monkeypatch):
    """Two hundred copies of one article hand on its lines once; every copy still counts, as p6_found counts chunks."""
    rng = random.Random(4)
    word = lambda n: " ".join(rng.choice(WORDS) for _ in range(n)) + " " + "".join(rng.choice("abcdefgh") for _ in range(12))
    article = [word(6) for _ in range(6)]
    body = [[*(f"{x}  {i}" for x in article), "short"] if i < 200 else [word(6) for _ in range(4)] + ["Read our legal notice here"] * (i < 240) for i in range(300)]
    rows = [(i, ["a", "b"][i % 2], "\r\n".join(b), f"2024-05-{1 + i % 9:02d} 00:00:00") for i, b in enumerate(body)]
    rows += rows[:50] + [(900, "a", None, None), (901, " ", rows[0][2], None), (902, None, rows[0][2], None)]
    spark.createDataFrame(rows, "chunk_id bigint, source_name string, text string, at string").selectExpr("*", "timestamp(at) as extracted_at").write.parquet(f"{tmp_path}/chunks.parquet")
    held, staged = [], lines.staged

    def seen(df, name):
        out = staged(df, name)
        if "keys" in out.columns:
            held.append(out.select("source", F.explode("keys")).count())
        return out

    monkeypatch.setattr(lines, "staged", seen)
    got = {(r["chunk_id"], r["line_no"]) for r in lines.p6_found(spark, str(tmp_path)).collect()}
    assert got == {(i, n) for i, b in enumerate(body) for n, x in enumerate(b) if i < 200 and x != "short" or x.startswith("Read our")}
    assert held == [2 * 6 + 100 * 4 + 40]
    r = lines.repeated_lines(lines._chunks(spark, str(tmp_path))).collect()
    assert sorted((x["source"], x["n_chunks"], x["n_clusters"], x["n_days"], x["n_source"]) for x in r) == [("a", 20, 20, 2, 151)] + [("a", 100, 1, 2, 151)] * 6 + [("b", 20, 20, 2, 150)] + [("b", 100, 1, 2, 150)] * 6


def test_cut_texts(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        t = " ".join(f"The report of the {rng.choice(WORDS)} was moved near gate {rng.randrange(99)}." for _ in range(rng.randrange(3, 14)))
        rows.append((i, "a" if i % 2 else "b", "/x.pdf", 1, t[:200] if i % 2 else t))
    rows += [(1000, "b", "/x.pdf", 1, "The report was moved. The rep"), (1001, "b", "/x.pdf", 1, "It was moved.\nAnnual report notes"), (1002, "b", None, None, None), (1003, None, None, None, " ")]
    rows += [(1004, "b", "/x.pdf", 1, "| a | b |\n| - | - |\n| 1 | 2 |\n| 3"), (1005, "b", "/x.pdf", 1, "| a | b |\n| - | - |\n| 1 | 2 |\n| 3 | 4 |")]
    cut, every = cuts.truncated(spark.createDataFrame(rows, "id bigint, source string, path string, page int, text string"), frozenset("the of was near".split()))
    got = {r["id"] for r in cut.collect()}
    whole = {r[0] for r in rows if r[4] and r[4].strip() and r[4].rstrip()[-1:] == "."}
    long = {r[0] for r in rows[:300] if len(r[4]) == 200 and r[4].rstrip()[-1] != "."}
    assert long | {1000, 1004} <= got and not got & (whole | {1001, 1002, 1003, 1005})
    assert {r["id"] for r in every.collect()} >= got


def test_limits_by_neighbouring_hazards(spark):
    """As many ends at a length are a limit where few texts reach it, and none where the neighbours' hazard foretells them."""
    rows, k = [], 0
    for source, extra in (("plain", 0), ("cut", 40)):
        for length in range(100, 180):
            for _ in range(max(1, round(300 * 0.93 ** (length - 100))) + (extra if length == 160 else 0)):
                rows.append((k, source, length, length * 2 + k % 7))
                k += 1
    found = cuts.limits(spark.createDataFrame(rows, "id bigint, source string, chars int, octets int")).collect()
    assert {(r["source"], r["length"]) for r in found if r["unit"] == "chars"} == {("cut", 160)}
    assert all(r["hazard"] > r["near_hazard"] for r in found)


def test_openings_by_share_at_any_size(spark):
    body = ["The gate was moved. The clerk read 4.5 pages\nof it twice.", "Annual report of the gate", "Annual report notes", "Annual report was moved."]
    few = texts(spark, list(enumerate(body * 4))).select("text")
    many = texts(spark, list(enumerate(body * 60))).select("text")
    keys = dict(zip(cuts._start_keys([("The", "gate"), ("The", "clerk"), ("Annual", "report")]).tolist(), ("gate", "clerk", "report")))
    for t in (few, many):
        assert {keys[r[0]] for r in cuts.opening_pairs(t).collect()} == {"gate", "clerk"}


def test_ids_are_exact(spark):
    path = f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken"
    plain = tokens.Engine(path)
    rng = random.Random(2)
    odd = ["", None, " ", "\n\n  x", "a" * 3000, "日本語" * 400, "<|endoftext|> it's", "x  y 　 z\t\t\n" * 90, "🙂é" * 200]
    rows = [(i, t) for i, t in enumerate(odd)] + [(100 + i, make(rng, rng.randrange(1, 900)) + " '" * (i % 3)) for i in range(60)]
    passage = make(rng, 700)
    rows += [(200 + i, make(rng, 90) + " " + passage + "." * (i % 2) + make(rng, i)) for i in range(12)] + [(300 + i, "見出し" * i + "この報告書は検査の間に、別の型を示しています。" * 60) for i in range(4)]
    rows += [(0, passage), (0, ""), (0, None), (None, passage), (211, passage), (200, dict(rows)[200])]
    ids = lambda t: plain.encoding.encode_ordinary(t) if t else []
    got = tokens.encoded(texts(spark, rows)).collect()
    assert sorted((r["id"] or -1, r["ids"]) for r in got) == sorted((i or -1, ids(t)) for i, t in rows)
    assert tokens.encoded(texts(spark, [])).count() == 0


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    """A passage of many texts is the same chunks in all of them, wherever it stands."""
    rng = random.Random(6)
    passage = make(rng, 1500)
    many = [make(rng, 40 + i) + " " + passage for i in range(8)]
    doc, start, end, h = tokens.boundaries(many)
    seen: dict = {}
    for d, a, b, x in zip(doc, start, end, h):
        seen.setdefault(x, []).append(many[d][a:b])
    assert all(len(set(v)) == 1 for v in seen.values()) and sum(len(v) == 8 for v in seen.values()) > 5
    assert ["".join(t[a:b] for k, a, b in zip(doc, start, end) if k == d) for d, t in enumerate(many)] == many


def test_vocabulary_pattern_matches_library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(f"{tokens.TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    e = tokens.Engine(f"{tokens.TOKENIZERS}/byte_bpe_50k.tiktoken")
    for x in ("It's  a\n\n test  ", "x　y 12ab", " lead", "tail \n"):
        assert e.encode(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_packing(spark):
    rng = random.Random(4)
    items = [(i, rng.choice([7, 7, 7, rng.randrange(1, 260)])) for i in range(3000)] + [(9000, 0), (9001, None)]
    got = packing.packed(spark.createDataFrame(items, "id bigint, size int"), {1: 100, 2: 64}).collect()
    for limit, cap in ((1, 100), (2, 64)):
        rows = [r for r in got if r["limit_id"] == limit]
        room, size = {}, {}
        for r in rows:
            room[r["container"]] = room.get(r["container"], 0) + r["size"]
            size[r["id"]] = size.get(r["id"], 0) + r["size"]
        assert max(room.values()) <= cap and size == {i: s for i, s in items if s}
        whole = [i for i, s in items if s and s <= cap]
        parts = [r["id"] for r in rows]
        assert all(parts.count(i) == 1 for i in whole[:200])
        assert len(room) <= 1.01 * sum(size.values()) / cap + 1
        full = sorted(r["container"] for r in rows if r["container"] < 0)
        assert full == list(range(-len(full), 0)) and min(r["container"] for r in rows if r["container"] >= 0) == 0
    assert packing.packed(spark.createDataFrame([], "id bigint, size int"), {1: 100}).count() == 0
    best = packing.fill({30: 2, 25: 1, 9: 3}, 64)
    assert sum(n * k for n, k in best) == 64


def test_languages(spark, sf):
    common = [(r["language"], r["word"]) for r in spark.read.parquet(f"{sf}/common_words.parquet").collect()]
    obs = spark.read.parquet(f"{sf}/observations.parquet").where("text is not null and language is not null").collect()
    rows = [(i, "en", f"the report {i}") for i in range(300)]
    kept = []
    for parts in (4, 40):
        held = []
        fit, languages_fit = languages.fit, lambda t, c, f: held.extend(t)
        languages.fit, bound = languages_fit, languages.FIT_ROWS
        languages.FIT_ROWS = 20
        languages._model(spark.createDataFrame(rows, "id bigint, label string, text string").repartition(parts), spark.createDataFrame([], "language string, word string"), "")
        languages.fit, languages.FIT_ROWS = fit, bound
        kept.append(sorted(held))
    assert kept[0] == kept[1] and 10 <= len(kept[0]) <= 20
    model = languages.fit([(languages.label_of(r["language"]), r["text"]) for r in obs], common)
    cases = {"en": "The report of the annual clerk was moved before the season.", "de": "Der Bericht zeigt die wichtigsten Zahlen ohne weitere Erklärung.", "fr": "Le contrat montre les règles d'accès pour tous les participants.", "vi": "Kho hang cu xac nhan danh sach thiet bi cho den cuoi tuan.", "ru": "Старый архив проверяет весь журнал Norbel.", "ja": "この報告書は検査の間に、別の型を示しています。"}
    for lang, t in cases.items():
        assert [s[2] for s in languages.segments(t, model, {})] == [lang]
    both = cases["en"] + " " + cases["de"]
    seg = languages.segments(both, model, {})
    assert [s[2] for s in seg] == ["en", "de"] and all(s[3] > 0.9 for s in seg) and both[seg[1][0] : seg[1][1]].strip() == cases["de"]
    assert languages.segments("123 | 456", model, {}) == []
    got = languages.identify(spark.createDataFrame([(1, "en", cases["de"]), (2, None, None), (3, "x", "")], "id bigint, label string, text string"), model).collect()
    assert [(r["id"], r["language"]) for r in got] == [(1, "de")]
    assert [languages.label_of(x) for x in ("en-US", "GERMAN", "Français", "und", None, "nl")] == ["en", "de", "fr", "", "", "?"]


def test_quality(spark, sf):
    common = quality._common(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    extra = [(-1, "| a | b |\n| --- | --- |\n" + "| x | 12 |\n" * 30), (-2, "- red ledger\n- blue gate, 4\n" * 12), (-3, "xkcd qwrt zzpl " * 3 + "fgh jklm npqrst vwx " * 12), (-4, "The report was moved. The clerk of the gate was at the river before the end of the season. " * 8), (-5, None), (-6, " \n")]
    got = {r["id"]: r for r in quality.outliers(docs.union(texts(spark, extra)), common).collect()}
    assert [got[-i]["kind"] for i in (1, 2, 3, 4)] == ["table", "list", "junk", None] and -5 not in got and -6 not in got
    assert abs(sum(got[-1]["contributions"]) - got[-1]["distance"]) < 1e-6 * got[-1]["distance"]
    assert quality.outliers(texts(spark, []), common).count() == 0
    stats = quality.p10_statistics(spark, sf).collect()
    assert len(stats) == docs.where("rlike(text, '\\\\S')").count() and all(r["leading"] in quality.STATS and r["distance"] >= 0 for r in stats)


def test_kinds_follow_from_contributions():
    """Without its distance or its contributions a document has no kind, and the group that contributes most decides."""
    c = np.zeros((4, quality.D))
    c[0, quality.STATS.index("list_part")] = c[1, quality.STATS.index("table_part")] = c[2, quality.STATS.index("vowels")] = c[3, quality.STATS.index("log_words")] = 900.0
    yes, far = np.ones(4, bool), np.full(4, 900.0)
    assert quality.kinds_of(far, c, yes, yes * 0.9) == ["list", "table", "junk", None]
    assert quality.kinds_of(far * 0.01, c, yes, yes * 0.9) == [None] * 4
    assert quality.kinds_of(far, c, ~yes, yes * 0.2) == [None] * 4
    c[0, quality.STATS.index("table_part")] = 1000.0
    assert quality.kinds_of(far, c, yes, yes * 0.9)[0] == "table"
