"""Languages of texts and of their segments: segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over all
its segmentations into pieces (a forward pass over its bytes), for all languages at once; a sentence's score is the sum of
its words' logarithms, and the confidence the posterior among the languages. The piece probabilities are fitted by
expectation maximisation on a bounded sample of labelled texts, twice, the second time without texts whose label the first
fit contradicts. Words are scored once for as long as a worker keeps them.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm.tokens import TOKENIZERS
from pagemill.runtime import prepare, table

LANGUAGES = ("en", "de", "fr", "es", "it", "vi", "ru", "ja")
#: Bound of the sample of labelled texts that the model is fitted on, rounds of expectation maximisation, longest piece in bytes, smoothing.
FIT_ROWS, EM_ROUNDS, LONGEST, ALPHA = 8_000, 2, 12, 0.02
#: Of the sample, the model is fitted on words met so often at least (those met once are names for the most part), and on so many bytes of a word.
LEAST_MET, FIT_BYTES = 2, 96
#: A sentence has a language of its own with so many words (or Japanese characters) and such odds (natural logarithm) over the next language.
LEAST_WORDS, LEAST_CHARS, ODDS = 3, 6, 4.0
VOCABULARY = "byte_bpe_multi_50k.tiktoken"

# Codes and names of the languages, and words for an unknown one.
SPELLINGS = {
    "en": "en eng english englisch anglais inglés ingles inglese tiếng-anh английский 英語",
    "de": "de deu ger german deutsch allemand alemán aleman tedesco tiếng-đức немецкий ドイツ語",
    "fr": "fr fra fre french französisch franzoesisch français francais francés frances francese tiếng-pháp французский フランス語",
    "es": "es spa spanish spanisch espagnol español espanol castellano spagnolo tiếng-tây-ban-nha испанский スペイン語",
    "it": "it ita italian italienisch italien italiano tiếng-ý итальянский イタリア語",
    "vi": "vi vie vietnamese vietnamesisch vietnamien vietnamita tiếng-việt вьетнамский ベトナム語",
    "ru": "ru rus russian russisch russe ruso russo русский tiếng-nga ロシア語",
    "ja": "ja jp jpn japanese japanisch japonais japonés japones giapponese tiếng-nhật японский 日本語",
}
UNKNOWN = frozenset("unknown und unk undetermined undefined none null na n/a nan ? - -- other mis mul zxx xx unbekannt inconnu desconocido".split())
_CODES = {x.replace("-", " "): k for k, v in SPELLINGS.items() for x in v.split()}

_SENTENCES = re.compile(r"(?:[^.!?。！？\n]|[.](?=\w))+[.!?。！？…]*")
_WORDS = re.compile(r"[^\W\d_]+(?:[̀-ͯ]+[^\W\d_]*)*")
_CJK = re.compile(r"[぀-ヿ㐀-䶿一-鿿]")


def label_of(label: str | None) -> str | None:
    """Two letters for one of our languages in any spelling, '' for a label that is missing, '?' for any other."""
    s = unicodedata.normalize("NFC", (label or "")).strip().casefold()
    if not s or s in UNKNOWN:
        return ""
    s = s.replace("_", "-")
    return _CODES.get(s) or _CODES.get(s.replace("-", " ")) or _CODES.get(re.split(r"[-. (]", s)[0]) or "?"


class Pieces:
    """The vocabulary: pieces up to LONGEST bytes."""

    def __init__(self, folder: str):
        with open(f"{folder}/{VOCABULARY}", "rb") as f:
            tokens = [base64.b64decode(x.split()[0]) for x in f]
        self.of = {t: i for i, t in enumerate(t for t in tokens if len(t) <= LONGEST)}


_pieces: dict[str, Pieces] = {}


def pieces(folder: str) -> Pieces:
    if folder not in _pieces:
        _pieces[folder] = Pieces(folder)
    return _pieces[folder]


def _arcs(word: bytes, of: dict[bytes, int]) -> list[list[tuple[int, int]]]:
    """For each end, (start, piece) of the pieces that end there."""
    n = len(word)
    return [[(j, p) for j in range(max(0, e - LONGEST), e) if (p := of.get(word[j:e])) is not None] for e in range(1, n + 1)]


def word_score(word: bytes, of: dict[bytes, int], prob: dict[int, np.ndarray], floor: np.ndarray) -> np.ndarray:
    """log probability of the word in each language, summed over its segmentations."""
    n = len(word)
    alpha = np.zeros((n + 1, len(floor)))
    alpha[0] = 1.0
    scale = np.zeros(len(floor))
    for e, arcs in enumerate(_arcs(word, of), 1):
        for j, p in arcs:
            alpha[e] += alpha[j] * prob.get(p, floor)
        if e % 24 == 0:  # keep within range
            lo = max(0, e - LONGEST)
            top = np.maximum(alpha[lo : e + 1].max(axis=0), 1e-300)
            alpha[lo : e + 1] /= top
            scale += np.log(top)
    return np.log(np.maximum(alpha[n], 1e-300)) + scale


def fold(text: str) -> str:
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text).lower()


def bare(text: str) -> str:
    """Without accents; Japanese marks stay."""
    if text.isascii() or _CJK.search(text):
        return text
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", text) if not 0x300 <= ord(c) <= 0x36F)).replace("đ", "d")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text)


def _bytes(word: str) -> bytes:
    return word.encode() if _CJK.search(word) else b" " + word.encode()


def _expect(counts: Counter, of: dict[bytes, int], p: dict[int, float], floor: float) -> Counter:
    """Expected piece counts of the words under all segmentations."""
    out: Counter = Counter()
    for word, n in counts.items():
        w = _bytes(word)[:FIT_BYTES]
        arcs = _arcs(w, of)
        a = [1.0] + [0.0] * len(w)
        for e, x in enumerate(arcs, 1):
            a[e] = sum(a[j] * p.get(i, floor) for j, i in x)
        b = [0.0] * len(w) + [1.0]
        for e in range(len(w), 0, -1):
            for j, i in arcs[e - 1]:
                b[j] += p.get(i, floor) * b[e]
        z = a[len(w)]
        if z > 0:
            for e, x in enumerate(arcs, 1):
                for j, i in x:
                    c = a[j] * p.get(i, floor) * b[e] / z
                    if c > 1e-6:
                        out[i] += n * c
    return out


def fit(texts: list[tuple[str, str]], common: list[tuple[str, str]], folder: str = TOKENIZERS) -> dict:
    """The model from (language, text) rows and (language, frequent word) rows: piece probabilities of all languages."""
    of = pieces(folder).of
    rows = [(lang, Counter(words_of(fold(t)))) for lang, t in texts if lang in LANGUAGES]
    model: dict = {}
    for turn in range(2):
        counts = {k: Counter({w: 5 for lang, w in common if lang == k}) for k in LANGUAGES}
        cache: dict = {}
        for lang, words in rows:
            if turn and words and LANGUAGES[int(np.argmax(sum(entry(w, model, cache)[0] * n for w, n in words.items())))] != lang:
                continue
            counts[lang].update(words)
        p_all: list[tuple[dict[int, float], float]] = []
        for lang in LANGUAGES:
            words = Counter({w: n for w, n in counts[lang].items() if n >= LEAST_MET})
            for w, n in list(words.items()):  # texts lose their accents at times
                if (x := bare(w)) != w:
                    words[x] += max(1, n // 4)
            p: dict[int, float] = {}
            floor = 1 / len(of)
            for _ in range(EM_ROUNDS):
                c = _expect(words, of, p, floor)
                total = sum(c.values()) + ALPHA * len(of)
                floor = ALPHA / total
                p = {i: (v + ALPHA) / total for i, v in c.items()}
            p_all.append((p, floor))
        floor_all = np.array([f for _, f in p_all])
        prob: dict[int, np.ndarray] = {}
        for k, (p, _) in enumerate(p_all):
            for i, v in p.items():
                prob.setdefault(i, floor_all.copy())[k] = v
        model = {"prob": prob, "floor": floor_all, "folder": folder}
    return model


def entry(word: str, model: dict, cache: dict) -> tuple[np.ndarray, int, str, int]:
    """Of a word: log probabilities, how many words it counts as (Japanese: by characters), script, weight by letters (a
    Japanese character counts as two)."""
    e = cache.get(word)
    if e is None:
        cjk = _CJK.search(word) is not None
        script = "cjk" if cjk else "cyrillic" if "\u0400" <= word[0] <= "\u052f" else "latin"
        s = word_score(_bytes(word), pieces(model["folder"]).of, model["prob"], model["floor"])
        e = cache[word] = (s, max(1, len(word) * LEAST_WORDS // LEAST_CHARS) if cjk else 1, script, len(word) * (2 if cjk else 1))
    return e


def leading_script(entries: list[tuple]) -> list[tuple]:
    """The words in the script of most letters: names and quotations in another script say nothing about a sentence's
    language."""
    if len({e[2] for e in entries}) < 2:
        return entries
    size: Counter = Counter()
    for e in entries:
        size[e[2]] += e[3]
    lead = size.most_common(1)[0][0]
    return [e for e in entries if e[2] == lead]


def segments(text: str, model: dict, cache: dict) -> list[tuple[int, int, str, float, int]]:
    """(start, end, language, confidence, words) of the stretches of a text in one language. Sentences without enough of
    their own evidence go with the one before them (or after, at the start). No words, no segments."""
    if len(cache) > 200_000:
        cache.clear()
    parts = []
    for m in _SENTENCES.finditer(text):
        entries = leading_script([entry(w, model, cache) for w in words_of(fold(m.group()))])
        if entries:
            s, n = np.add.reduce([e[0] for e in entries]), sum(e[1] for e in entries)
            order = np.sort(s)
            parts.append([m.start(), m.end(), s, n, n >= LEAST_WORDS and order[-1] - order[-2] >= ODDS])
    if not parts:
        return []
    if not any(p[4] for p in parts):
        parts = [[parts[0][0], parts[-1][1], sum(p[2] for p in parts), sum(p[3] for p in parts), True]]
    out: list[list] = []
    waiting: list = []
    for p in parts:
        lang = int(np.argmax(p[2]))
        if not p[4]:
            if out:
                out[-1][1], out[-1][3], out[-1][4] = p[1], out[-1][3] + p[2], out[-1][4] + p[3]
            else:
                waiting.append(p)
            continue
        if out and out[-1][2] == lang:
            out[-1][1], out[-1][3], out[-1][4] = p[1], out[-1][3] + p[2], out[-1][4] + p[3]
        else:
            start = waiting[0][0] if waiting and not out else p[0]
            out.append([start, p[1], lang, p[2] + sum((w[2] for w in waiting), np.zeros(len(LANGUAGES))) if not out else p[2], p[3]])
            waiting = []
    res = []
    for a, b, lang, s, n in out:
        x = s - s[lang]
        res.append((a, b, LANGUAGES[lang], float(1 / np.exp(np.minimum(x, 700)).sum()), n))
    return res


def _model(sample: DataFrame, common: DataFrame, folder: str) -> dict:
    """Fits on at most FIT_ROWS labelled texts, those with the least hash of id and text. A bound on the hash by the number
    of texts comes first, so that what the partitions send to the driver doesn't grow with their number."""
    sample = sample.where("text is not null and label is not null").select("label", "text", F.xxhash64("id", "text").alias("h"))
    n = sample.count()
    if n > 2 * FIT_ROWS:
        sample = sample.where(F.col("h") < int(-(2**63) + 2**64 * 1.1 * FIT_ROWS / n))
    rows = sample.orderBy("h").limit(FIT_ROWS).select("label", "text").collect()
    words = [(r["language"], r["word"]) for r in common.collect()]  # a fixed table
    return fit([(label_of(r["label"]) or "", r["text"]) for r in rows], words, folder)


def identify(texts: DataFrame, model: dict) -> DataFrame:
    """(id, label, start, end, language, confidence, words) of each segment of (id, label, text) rows.

    Null and blank texts and texts without words have none. Rows sent again stay repeated; positions are characters.
    """
    spark = prepare(texts.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary

    def of(batches):
        model, cache = shared.value, {}
        for batch in batches:
            ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = [(ids[i], labels[i], *s) for i, t in enumerate(batch.column(2).to_pylist()) if t for s in segments(t, model, cache)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.int32()))], names=["id", "label", "start", "end", "language", "confidence", "words"])

    return texts.select("id", "label", "text").where("id is not null and text is not null").mapInArrow(of, "id bigint, label string, `start` int, `end` int, language string, confidence double, words int")


def _fitted(spark: SparkSession, sf_dir: str) -> dict:
    obs = table(spark, sf_dir, "observations").select(F.col("observation_id").alias("id"), F.col("language").alias("label"), "text").where("trim(language) <> ''")
    return _model(obs, table(spark, sf_dir, "common_words").select("language", "word"), TOKENIZERS)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    obs = table(spark, sf_dir, "observations").select(F.col("observation_id").alias("id"), F.col("language").alias("label"), "text")
    seg = identify(obs, _fitted(spark, sf_dir))
    per = seg.groupBy("id", "label").agg(F.collect_set("language").alias("langs"))
    rows = per.select("id", "label", F.explode("langs").alias("language"), F.size("langs").alias("n"))
    return rows.mapInArrow(_cases, "observation_id bigint, language string").distinct()


def _cases(batches):
    for batch in batches:
        got = [(k, lang) for k, label, lang, n in zip(*(batch.column(c).to_pylist() for c in range(4))) if n > 1 or label_of(label) != lang]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in got], pa.int64()), pa.array([r[1] for r in got], pa.string())], names=["observation_id", "language"])


def p7_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of all chunks, each chunk once."""
    chunks = table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), F.lit(None).cast("string").alias("label"), "text").dropDuplicates(["id"])
    return identify(chunks, _fitted(spark, sf_dir)).select(F.col("id").alias("chunk_id"), F.col("start").alias("start_at"), F.col("end").alias("end_at"), "language", F.round("confidence", 6).alias("confidence"), F.col("words").alias("n_words"))


QUERIES = {"p7_found": p7_found, "p7_segments": p7_segments}
SQL: dict[str, str] = {}
