"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Base patterns (kinds ``assign``, ``access``, ``hex``) are matched over each whole text, leftmost
and non-overlapping per kind; matches that are too short are dropped afterwards.  The method
then looks at the other long runs of token characters.  Of each run:

* the encoding is inferred: the smallest alphabet that holds all its characters (padding aside);
* three tests ask whether it was drawn evenly from that alphabet: chi-squared of the symbol
  counts, number of runs above and below the alphabet's middle, and lag-one serial correlation;
  Fisher's method combines them into one score (low: looks random);
* ordinary text looks random too if it is short enough, so the score is held against decoys:
  stretches of the same document's remaining text, reduced to the same alphabet and cut to the
  same length.  The p-value is the share of decoys of this encoding, of the same length class or
  a shorter one, that look at least as random.  A run whose encoding has no decoys is never reported;
* Benjamini-Hochberg over all runs of the corpus keeps the share of ordinary runs among the
  reported ones at ``fdr``.

Scanning is one pass over the documents; what is added up over the corpus is a histogram per
(encoding, length class, score class), whose size does not grow with the data.

Defined results: null text counts as empty and has no spans.  Offsets count code points, ends are
exclusive.  Repeated rows are scanned each by itself (and count each), ids may be null, an empty
table gives an empty result; input columns of any name other than the text are kept in the
struct ``row``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm.common import Scratch, slices

KINDS = ("assign", "access", "hex", "random")

# fixed patterns
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Encodings by growing alphabet, in natural order of their symbols; all sizes are even.
ALPHABETS = {
    "decimal": _DIGITS, "hex": _DIGITS + _LOWER[:6], "upper hex": _DIGITS + _UPPER[:6], "lower": _LOWER, "upper": _UPPER,
    "base32": _UPPER + "234567", "lower base36": _DIGITS + _LOWER, "upper base36": _DIGITS + _UPPER, "letters": _UPPER + _LOWER,
    "base62": _DIGITS + _UPPER + _LOWER, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
    "mixed": _UPPER + _LOWER + _DIGITS + "+/-_",
}
_NAMES = list(ALPHABETS)
_SETS = [frozenset(a) for a in ALPHABETS.values()]
_OTHERS = [re.compile(f"[^{re.escape(a)}]+") for a in ALPHABETS.values()]
_CODES = []
for _a in ALPHABETS.values():
    _table = np.zeros(128, np.int64)
    _table[[ord(c) for c in _a]] = np.arange(len(_a))
    _CODES.append(_table)

#: Score classes are quarters of a power of ten of the combined p-value; the last one is open.
SCORE_CLASSES = 128


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    # runs of one class: asking for the length at once finds what dropping shorter ones leaves
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def encoding_of(token: str) -> int:
    """Number of the smallest alphabet that holds the token."""
    used = set(token)
    return next(i for i, s in enumerate(_SETS) if used <= s)


def length_class(n: int) -> int:
    return int(2 * math.log2(n))


def battery(token: str, encoding: int) -> tuple[float, float, float]:
    """p-values, for a token drawn evenly from the alphabet, of its chi-squared uniformity (one
    side), its number of runs and its serial correlation (two sides)."""
    codes = _CODES[encoding][np.frombuffer(token.encode("ascii"), np.uint8)]
    n, size = len(codes), len(_SETS[encoding])
    counts = np.bincount(codes, minlength=size)
    chi = (counts.astype(float) ** 2).sum() * size / n - n
    w = 2 / (9 * (size - 1))  # Wilson and Hilferty: the cube root is nearly normal
    z = (max(chi, 0.0) / (size - 1)) ** (1 / 3) / math.sqrt(w) - (1 - w) / math.sqrt(w)
    high = codes >= size // 2
    runs = 1 + int((high[1:] != high[:-1]).sum())
    r = (runs - (n + 1) / 2) / math.sqrt((n - 1) / 4)
    u = codes - (size - 1) / 2
    s = float((u[1:] * u[:-1]).sum()) / ((size * size - 1) / 12) / math.sqrt(n - 1)
    return math.erfc(z / math.sqrt(2)) / 2, math.erfc(abs(r) / math.sqrt(2)), math.erfc(abs(s) / math.sqrt(2))


def score_class(token: str, encoding: int) -> int:
    """Class of Fisher's combined p-value: 0 looks random, higher ones less so."""
    x = -sum(math.log(max(p, 1e-300)) for p in battery(token, encoding))
    combined = math.log(1 + x + x * x / 2) - x  # log of the chi-squared tail with 6 degrees of freedom
    return min(int(-4 * combined / math.log(10)), SCORE_CLASSES - 1)


def scan(text: str, min_length: int, decoys: int) -> tuple[list, list, list]:
    """Base spans; candidates (start, end, encoding, length class, score class); and decoys
    (encoding, length class, score class, count) of one text."""
    base = base_spans(text)
    candidates, tokens, cut = [], [], []
    at, reach = 0, -1
    for m in re.finditer(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % min_length, text):
        while at < len(base) and base[at][0] <= m.start():
            reach = max(reach, base[at][2])
            at += 1
        cut.append((m.start(), m.end()))
        if m.end() <= reach:
            continue  # lies within a base span
        token = m[0].rstrip("=")
        e = encoding_of(token)
        candidates.append((m.start(), m.end(), e, length_class(len(token)), score_class(token, e)))
        tokens.append(token)
    found: Counter = Counter()
    if candidates:
        rest, last = [], 0
        for a, b in sorted(cut + [(s, t) for s, _, t in base]):
            if a > last:
                rest.append(text[last:a])
            last = max(last, b)
        rest.append(text[last:])
        ordinary = " ".join(rest)
        for e in sorted({c[2] for c in candidates}):
            pool = _OTHERS[e].sub("", ordinary)
            lengths = [len(t) for t, c in zip(tokens, candidates, strict=True) if c[2] == e for _ in range(decoys)]
            for k, n in enumerate(lengths):
                if len(pool) >= n:
                    start = k * (len(pool) - n) // len(lengths)
                    found[e, length_class(n), score_class(pool[start:start + n], e)] += 1
    return base, candidates, [(*key, n) for key, n in sorted(found.items())]


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64())])
_CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.int64()), ("length", pa.int64()), ("score", pa.int64())])
_DECOY = pa.struct([("encoding", pa.int64()), ("length", pa.int64()), ("score", pa.int64()), ("n", pa.int64())])


def _named(rows: list, of: pa.StructType) -> list:
    names = [of.field(i).name for i in range(of.num_fields)]
    return [[dict(zip(names, r, strict=True)) for r in each] for each in rows]


def scanned(docs: DataFrame, text: str = "text", min_length: int = 20, decoys: int = 8) -> DataFrame:
    """``row`` (the other input columns), ``base``, ``candidates`` and ``decoys`` of each document."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    df = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    spans = "array<struct<start:long,kind:long,end:long>>"
    schema = T.StructType([
        T.StructField("row", df.schema["row"].dataType), T.StructField("base", T.DataType.fromDDL(spans)),
        T.StructField("candidates", T.DataType.fromDDL("array<struct<start:long,end:long,encoding:long,length:long,score:long>>")),
        T.StructField("decoys", T.DataType.fromDDL("array<struct<encoding:long,length:long,score:long,n:long>>"))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [scan(t or "", min_length, decoys) for t in part.column("text").to_pylist()]
                columns = [pa.array(_named([f[i] for f in found], of), pa.list_(of)) for i, of in enumerate((_SPAN, _CANDIDATE, _DECOY))]
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns], names=schema.names)

    return df.mapInArrow(work, schema)


def thresholds(candidates: dict[tuple[int, int, int], int], decoys: dict[tuple[int, int, int], int], fdr: float) -> dict[tuple[int, int], int]:
    """(encoding, length class) -> highest score class that is reported, from the numbers of
    candidates and decoys per (encoding, length class, score class)."""
    p_values = {}
    for e, n, score in candidates:
        own = [(s, k) for (e2, n2, s), k in decoys.items() if e2 == e and n2 <= n]
        alike = sum(k for s, k in own if s <= score)
        p_values[e, n, score] = (1 + alike) / (1 + sum(k for _, k in own))
    total, rank, cut = sum(candidates.values()), 0, -1.0
    for key in sorted(p_values, key=lambda key: p_values[key]):
        rank += candidates[key]
        # equal p-values stand or fall together: the last of them decides
        if p_values[key] <= fdr * rank / total:
            cut = p_values[key]
    out: dict[tuple[int, int], int] = {}
    for (e, n, score), p in p_values.items():
        if p <= cut:
            out[e, n] = max(score, out.get((e, n), -1))
    return out


def find(docs: DataFrame, scratch: Scratch, text: str = "text", min_length: int = 20, decoys: int = 8, fdr: float = 0.05) -> DataFrame:
    """``row`` (input columns but the text), ``spans`` as an array of (start, kind number, end) in
    order of start and kind (see ``KINDS``), fixed patterns included."""
    seen = scratch.write(scanned(docs, text, min_length, decoys), "scanned")

    def histogram(column: str, weight) -> dict[tuple[int, int, int], int]:
        each = seen.select(F.explode(column).alias("c"))
        rows = each.groupBy("c.encoding", "c.length", "c.score").agg(F.sum(weight).alias("n")).collect()
        return {(r["encoding"], r["length"], r["score"]): r["n"] for r in rows}

    limits = thresholds(histogram("candidates", F.lit(1)), histogram("decoys", F.col("c.n")), fdr)
    limit = F.lit(-1)
    if limits:
        table = F.create_map(*[F.lit(v) for (e, n), score in sorted(limits.items()) for v in (e * 1000 + n, score)])
        random = F.filter("candidates", lambda c: c["score"] <= F.coalesce(
            F.try_element_at(table, (c["encoding"] * 1000 + c["length"]).cast("int")), limit))
    else:
        random = F.filter("candidates", lambda c: F.lit(False))
    added = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(3).cast("long").alias("kind"), c["end"].alias("end")))
    return seen.select("row", F.sort_array(F.concat("base", added)).alias("spans"))


def span_text(spans) -> F.Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, (s["kind"] + 1).cast("int")), s["start"], s["end"])), ",")
