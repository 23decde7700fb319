"""All queries of the subpackage, and their SQL."""

from pagemill.llm import cuts, languages, lines, neardup, packing, quality, scans, tokens, unify

QUERIES = {k: f for m in (scans, unify, neardup, cuts, lines, languages, tokens, packing, quality) for k, f in m.QUERIES.items()}
SQL = {k: q for m in (scans, unify, neardup, cuts, lines, languages, tokens, packing, quality) for k, q in m.SQL.items()}
