"""One consistent form for texts that look the same: DuckDB inside Arrow partitions.

Each Arrow batch is a DuckDB table and one embedded SQL statement maps it: Unicode composition with nfc_normalize,
compatibility forms and spaces with translate, invisible characters with regular expressions, look-alike letters word by
word towards the script that has more letters in the word.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.runtime import prepare, table

# Unicode blocks and pairs of letters with the same shape, in natural order.
FULL = "".join(chr(c) for a, b in ((0xFF10, 0xFF1A), (0xFF21, 0xFF3B), (0xFF41, 0xFF5B)) for c in range(a, b))
PLAIN = "".join(chr(ord(c) - 0xFEE0) for c in FULL)
INVISIBLE = "\\x{00AD}\\x{034F}\\x{061C}\\x{115F}\\x{1160}\\x{17B4}\\x{17B5}\\x{180B}-\\x{180E}\\x{200B}-\\x{200F}\\x{202A}-\\x{202E}\\x{2060}-\\x{2064}\\x{2066}-\\x{206F}\\x{FEFF}"
SPACES = "               　"
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ĳ": "ij", "Ĳ": "IJ", "ǆ": "dž", "ǉ": "lj", "ǌ": "nj"}
#: Cyrillic and Greek letters, and the Latin letters of the same shape.
FOREIGN = "АВЕЅІЈКМНОРСТУХаеорсухіјѕһԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορτυχικ"
LATIN = "ABESIJKMHOPCTYXaeopcyxijshdqw" + "ABEZHIKMNOPTYXavoptuxik"
#: Latin letters towards Cyrillic, for words that are Cyrillic for the larger part.
TO_CYRILLIC = ("ABESIJKMHOPCTYXaeopcyxijs", "АВЕЅІЈКМНОРСТУХаеорсухіјѕ")
TO_GREEK = ("ABEZHIKMNOPTYXavopux", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυχ")

_Q = lambda s: "'" + s.replace("'", "''") + "'"
_ligatures = lambda x: __import__("functools").reduce(lambda q, kv: f"replace({q}, {_Q(kv[0])}, {_Q(kv[1])})", LIGATURES.items(), x)
MIXED = r"[\p{Latin}][\p{Cyrillic}\p{Greek}]|[\p{Cyrillic}\p{Greek}][\p{Latin}]"
MIXED_WORD = r"[\p{Latin}][\p{L}\p{M}]*[\p{Cyrillic}\p{Greek}]|[\p{Cyrillic}\p{Greek}][\p{L}\p{M}]*[\p{Latin}]"

#: Everything but look-alikes. Texts of ASCII alone pass through unread.
BASE = f"""CASE WHEN NOT regexp_matches(text, '[^\\x00-\\x7F]') THEN text ELSE
  nfc_normalize({_ligatures(f"translate(regexp_replace(text, '[{INVISIBLE}]', '', 'g'), {_Q(FULL + SPACES)}, {_Q(PLAIN + ' ' * len(SPACES))})")}) END"""

_COUNT = lambda x, script: f"len(regexp_replace({x}, '[^{script}]', '', 'g'))"
_WORD = f"""CASE WHEN NOT regexp_matches(w, '{MIXED_WORD}') THEN w
  WHEN NOT regexp_matches(translate(w, {_Q(FOREIGN)}, {_Q(LATIN)}), '[\\p{{Cyrillic}}\\p{{Greek}}]') AND ({_COUNT('w', '\\p{Latin}')} >= {_COUNT('w', '\\p{Cyrillic}\\p{Greek}')}
    OR regexp_matches(translate(translate(w, {_Q(TO_CYRILLIC[0])}, {_Q(TO_CYRILLIC[1])}), {_Q(TO_GREEK[0])}, {_Q(TO_GREEK[1])}), '\\p{{Latin}}')) THEN translate(w, {_Q(FOREIGN)}, {_Q(LATIN)})
  WHEN regexp_matches(w, '\\p{{Cyrillic}}') THEN translate(w, {_Q(TO_CYRILLIC[0])}, {_Q(TO_CYRILLIC[1])})
  ELSE translate(w, {_Q(TO_GREEK[0])}, {_Q(TO_GREEK[1])}) END"""

CANONICAL = f"""SELECT id, CASE WHEN regexp_matches(base, '{MIXED}')
    THEN array_to_string(list_transform(regexp_extract_all(base, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+'), lambda w: {_WORD}), '') ELSE base END AS text
  FROM (SELECT id, {BASE} AS base FROM batch)"""

KINDS = {
    "fullwidth": f"regexp_matches(text, '[{FULL[0]}-{FULL[9]}{FULL[10]}-{FULL[35]}{FULL[36]}-{FULL[61]}]')",
    "decomposed": "regexp_matches(text, '\\p{L}[\\x{0300}-\\x{034E}\\x{0350}-\\x{036F}\\x{1AB0}-\\x{1ACE}\\x{1DC0}-\\x{1DFF}\\x{20D0}-\\x{20F0}\\x{3099}\\x{309A}\\x{FE20}-\\x{FE2F}]')",
    "zero_width": f"regexp_matches(text, '[{INVISIBLE}]')",
    "odd_space": f"regexp_matches(text, '[{SPACES}\\x{{000B}}\\x{{0085}}]')",
    "lookalike": f"regexp_matches(base, '{MIXED}') AND regexp_matches(base, '{MIXED_WORD}')",
    "ligature": f"regexp_matches(text, '[{''.join(LIGATURES)}]')",
}
DISGUISED = f"""SELECT id, unnest(list_filter([{', '.join(f"CASE WHEN {v} THEN '{k}' END" for k, v in KINDS.items())}], lambda x: x IS NOT NULL)) AS kind
  FROM (SELECT id, text, {BASE} AS base FROM batch WHERE regexp_matches(text, '[^\\x00-\\x7E]') OR regexp_matches(text, '\\x0B'))"""


def run_sql(statement: str):
    """A function for mapInArrow that runs the statement over each batch, as the table `batch`, in one DuckDB a task."""

    def of(batches):
        import duckdb

        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})
        for batch in batches:
            if batch.num_rows:
                con.register("batch", pa.Table.from_batches([batch]))
                out = con.sql(statement).to_arrow_table()
                con.unregister("batch")
                yield from out.to_batches()
        con.close()

    return of


def canonical_texts():
    """A function from an Arrow array of texts to the list of their consistent forms, with a DuckDB of its own."""
    import duckdb

    con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})

    def of(texts: pa.Array) -> list:
        con.register("batch", pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": texts}))
        out = con.sql(CANONICAL + " ORDER BY id").to_arrow_table()
        con.unregister("batch")
        return out.column("text").to_pylist()

    return of


def canonical(texts: DataFrame) -> DataFrame:
    """(id, text) with each text in the consistent form; null stays null, blank stays blank, rows are kept one for one.
    Extra columns are dropped: join them by id. Composition is canonical (NFC), case is left alone."""
    prepare(texts.sparkSession)
    return texts.select("id", "text").mapInArrow(run_sql(CANONICAL), "id bigint, text string")


def disguised(texts: DataFrame) -> DataFrame:
    """(id, kind), each once, for each kind of disguised character in the texts of an id; null and blank texts have none."""
    prepare(texts.sparkSession)
    return texts.select("id", "text").where("id is not null and text is not null").mapInArrow(run_sql(DISGUISED), "id bigint, kind string").distinct()


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disguised(table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), "text")).select(F.col("id").alias("chunk_id"), "kind")


def p2_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each chunk once, its text in the consistent form, and whether that differs from the text as stored."""
    chunks = table(spark, sf_dir, "chunks").select(F.col("chunk_id").alias("id"), "text")
    return canonical(chunks).dropDuplicates(["id"]).select(F.col("id").alias("chunk_id"), "text")


QUERIES = {"p2_found": p2_found, "p2_canonical": p2_canonical}
SQL: dict[str, str] = {}
