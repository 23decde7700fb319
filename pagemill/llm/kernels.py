"""Array kernels over batches of texts: code points, words, lines and their hashes without a Python loop per row.

A batch of texts becomes one array of code points with a separator between texts; words and lines are ranges of it, and
the hash of any range comes from prefix sums of a polynomial modulo 2^64 (the base is odd, so its powers have inverses).
"""

from __future__ import annotations

import numpy as np

SEP = 0xFFFF
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE_SIZE = 0x33480
_cache: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table(kind: str) -> np.ndarray:
    """Boolean table by code point: 'alnum', 'alpha', 'digit', 'space', or else the characters of `kind` itself."""
    if kind not in _cache:
        test = {"alnum": str.isalnum, "alpha": str.isalpha, "digit": str.isdigit, "space": str.isspace}.get(kind, frozenset(kind).__contains__)
        _cache[kind] = np.fromiter((test(chr(c)) for c in range(_TABLE_SIZE)), bool, _TABLE_SIZE)
    return _cache[kind]


def counts(a: np.ndarray, sep: np.ndarray, kind: str) -> np.ndarray:
    """How many characters of the kind each text of code_points has."""
    total = np.r_[0, np.cumsum(lookup(a, kind))]
    return total[sep] - total[np.r_[0, sep[:-1] + 1]]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "pow" not in _cache or len(_cache["pow"][0]) < n:
        size = 1 << max(16, int(n).bit_length())
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _cache["pow"] = tuple(out)
    p, q = _cache["pow"]
    return p[:n], q[:n]


def code_points(texts: list, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one SEP after each, and the position of each text's SEP. None counts as empty."""
    joined = "￿".join([t or "" for t in texts]) + "￿"
    if joined.count("￿") != len(texts):
        joined = "￿".join([(t or "").replace("￿", " ") for t in texts]) + "￿"
    if lower:
        joined = joined.lower()
    a = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return a, np.flatnonzero(a == SEP)


def lookup(a: np.ndarray, kind: str) -> np.ndarray:
    t = table(kind)
    return t[np.minimum(a, _TABLE_SIZE - 1)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    d = np.diff(mask.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def range_hashes(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    p, q = powers(len(a) + 1)
    s = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * p[: len(a)], out=s[1:])
    return mix((s[ends] - s[starts]) * q[starts] + np.uint64(0x51ED27))


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-case words (runs of letters and digits) of all texts in order, and the text of each."""
    a, sep = code_points(texts)
    starts, ends = runs(lookup(a, "alnum"))
    return range_hashes(a, starts, ends), np.searchsorted(sep, starts)


def shingles(texts: list, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k consecutive words, and the text of each; repeated ones stay."""
    w, doc = word_hashes(texts)
    n = len(w) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for i in range(k):
        h = h * np.uint64(0xD6E8FEB86659FD93) + w[i : i + n]
    same = doc[:n] == doc[k - 1 :]
    return mix(h[same]), doc[:n][same]


def unique_shingles(texts: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's set of shingles, sorted: hashes, offsets (one more than the texts), sizes."""
    h, doc = shingles(texts, k)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
    sizes = np.bincount(doc, minlength=len(texts))
    return h, np.concatenate([[0], np.cumsum(sizes)]), sizes


def one_permutation(h: np.ndarray, doc: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation minima (n x bins) with optimal densification: an empty bin takes the value of the first non-empty
    bin in a pseudo-random order of its own that is the same for all texts. Texts without shingles keep the maximum."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    m = np.full(n * bins, empty, np.uint64)
    b = ((h >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    np.minimum.at(m, doc * bins + b.astype(np.int64), mix(h + np.uint64(0x7F4A7C15)))
    m = m.reshape(n, bins)
    full = m != empty
    rows, cols = np.nonzero(~full & full.any(axis=1)[:, None])
    out, t = m.copy(), 0
    while len(rows):
        t += 1
        j = (mix(np.arange(bins, dtype=np.uint64) * np.uint64(0x2545F491) + np.uint64(t * 7919)) % np.uint64(bins)).astype(np.int64)[cols]
        ok = full[rows, j]
        out[rows[ok], cols[ok]] = m[rows[ok], j[ok]]
        rows, cols = rows[~ok], cols[~ok]
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """n x bands keys, each of `rows` neighbouring minima and the band's number."""
    n, k = sig.shape
    bands = k // rows
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64)[None, :] * np.uint64(0x9FB21C651E98DF25), (n, bands)).copy()
    s = sig[:, : bands * rows].reshape(n, bands, rows)
    for i in range(rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + s[:, :, i])
    return key
