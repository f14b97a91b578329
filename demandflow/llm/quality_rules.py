"""Quality rules: a learned decision list over text statistics, applied as one ordered Spark
conditional expression.

Statistics are Spark expressions over the whole text.  Rules are learned by sequential covering
from all labelled documents: a rule grows condition by condition (``statistic >= t`` or
``<= t``) by FOIL gain on the growing rows, is pruned to the prefix with the best
``(p - n) / (p + n)`` on the held-back rows, and joins the list if it is precise there; rows
that it covers are set aside and the next rule is grown.  Every count is one Spark aggregation
over all labelled rows; the driver sees only a histogram of (statistic, bin) counts.

Null and empty text have no words: all counts are 0, ``base_failed`` is true and ``kept`` false.
Repeated rows are judged alike, ties between thresholds go to the earlier statistic and the
lower threshold, an empty table gives an empty result, and with no labels the list is empty
(it rejects nothing beyond the base rules).  Extra columns, whatever their names, are kept by
:func:`with_statistics` behind a struct column and dropped by the query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import SPACE, Scratch

#: Output name -> SQL over the helper columns ``t`` (text), ``w`` (words), ``l`` (lines with a
#: word) and ``g`` (hash of each 3-word window).
_COUNTS = {
    "n_words": "size(w)",
    "word_chars": "char_length(array_join(w, ''))",
    "n_symbols": "char_length(t) - char_length(regexp_replace(t, '[#*$%&|<>]', ''))",
    "n_lines": "size(l)",
    "n_dup_lines": "size(l) - size(array_distinct(l))",
    "n_upper": "char_length(t) - char_length(regexp_replace(t, '[A-Z]', ''))",
    "n_bangs": "char_length(t) - char_length(replace(t, '!', ''))",
    "n_digits": "char_length(t) - char_length(regexp_replace(t, '[0-9]', ''))",
    "n_distinct": "size(array_distinct(w))",
}

# Words that lie in a 3-word window seen twice or more.  Windows are sorted by hash, so equal
# ones are neighbours; of their start positions in order, each covers up to three words.
_SORTED = "sort_array(transform(g, (x, i) -> struct(x AS g, i AS i)))"
_STARTS = ("sort_array(filter(transform(s, (x, k) -> if(coalesce(x.g = get(s, k - 1).g, false)"
           " OR coalesce(x.g = get(s, k + 1).g, false), x.i, null)), x -> x IS NOT NULL))")
_COVERED = "aggregate(transform(p, (x, k) -> least(3, coalesce(get(p, k + 1) - x, 3))), 0, (a, x) -> a + x)"

#: Statistics that rules may test: integers, mostly shares in thousandths.
FEATURES = {
    "f_words": "n_words",
    "f_word_length": "(100 * word_chars) DIV greatest(n_words, 1)",
    "f_symbols": "(1000 * n_symbols) DIV greatest(word_chars, 1)",
    "f_dup_lines": "(1000 * n_dup_lines) DIV greatest(n_lines, 1)",
    "f_repeats": "(1000 * n_repeat_words) DIV greatest(n_words, 1)",
    "f_upper": "(1000 * n_upper) DIV greatest(word_chars, 1)",
    "f_bangs": "(1000 * n_bangs) DIV greatest(n_words, 1)",
    "f_digits": "(1000 * n_digits) DIV greatest(word_chars, 1)",
    "f_distinct": "(1000 * n_distinct) DIV greatest(n_words, 1)",
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATISTICS = (*_COUNTS, "n_repeat_words")


def with_statistics(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of the input columns, so that no name can clash) and the statistics."""
    df = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    df = df.withColumn("t", F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    df = df.withColumn("w", F.array_remove(F.split("t", SPACE, -1), ""))
    df = df.withColumn("l", F.expr(r"filter(split(t, '\n', -1), x -> x RLIKE '[^\\x20\\x09-\\x0D]')"))
    df = df.withColumn("g", F.expr("if(size(w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(w) - 3),"
                                   " i -> xxhash64(get(w, i), get(w, i + 1), get(w, i + 2))))"))
    df = df.select("row", "g", *[F.expr(sql).cast("long").alias(n) for n, sql in _COUNTS.items()])
    df = df.withColumn("s", F.expr(f"if(size(array_distinct(g)) = size(g), null, {_SORTED})")).drop("g")
    df = df.withColumn("p", F.expr(f"if(s IS NULL, null, {_STARTS})")).drop("s")
    df = df.withColumn("n_repeat_words", F.expr(f"if(p IS NULL, 0, {_COVERED})").cast("long")).drop("p")
    return df.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: int

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{FEATURES[self.feature]} {'>=' if self.at_least else '<='} {self.threshold}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """The decision list as ordered conditionals: false for the first rule that fits."""
    out = None
    for rule in rules:
        out = F.when(_all(rule), F.lit(False)) if out is None else out.when(_all(rule), F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else -1.0


def _histogram(rows: DataFrame, names: list[str]) -> tuple[dict, int, int]:
    """Counts of (bad, good) rows by statistic and bin: at most statistics x bins entries."""
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"b_{n}").alias("b")) for i, n in enumerate(names)]))
    got = rows.select("bad", pairs.alias("x")).groupBy("x.f", "x.b").agg(
        F.sum(F.col("bad").cast("int")).alias("p"), F.sum((~F.col("bad")).cast("int")).alias("n")).collect()
    hist = {(r["f"], r["b"]): (r["p"], r["n"]) for r in got}
    p0 = sum(p for (f, _), (p, _) in hist.items() if f == 0)
    n0 = sum(n for (f, _), (_, n) in hist.items() if f == 0)
    return hist, p0, n0


def _best(hist: dict, thresholds: list[list[int]], p0: int, n0: int) -> tuple[float, int, bool, int, int, int] | None:
    """Of all single conditions the one with the highest gain (ties: first statistic, ``>=``
    first, lowest threshold).  Bin b holds values with exactly b thresholds at or below them."""
    best = None
    for f, cuts in enumerate(thresholds):
        at = [hist.get((f, b), (0, 0)) for b in range(len(cuts) + 1)]
        p_up, n_up = p0, n0
        for b in range(1, len(cuts) + 1):
            p_up, n_up = p_up - at[b - 1][0], n_up - at[b - 1][1]
            for side, (p, n) in ((True, (p_up, n_up)), (False, (p0 - p_up, n0 - n_up))):
                if p + n < p0 + n0:
                    g = _gain(p, n, p0, n0)
                    if g > 1e-9 and (best is None or g > best[0]):
                        best = (g, f, side, cuts[b - 1] if side else cuts[b - 1] - 1, p, n)
    return best


def learn(stats: DataFrame, labels: DataFrame, scratch: Scratch, bins: int = 64, max_rules: int = 16,
          max_conditions: int = 4, min_precision: float = 0.95, min_rows: int = 5) -> list[Rule]:
    """Rules that describe documents with label ``quality = 0`` among those that pass the base
    rules.  ``stats`` holds ``doc_id`` and the statistics, ``labels`` holds ``doc_id, quality``.
    One third of the rows, by hash of the id, is held back for pruning."""
    names = list(FEATURES)
    good = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = stats.where("NOT base_failed").join(good, "doc_id").select(
        (F.col("quality") == 0).alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), *STATISTICS,
        *[F.expr(sql).alias(n) for n, sql in FEATURES.items()])
    rows = scratch.write(rows, "labelled")
    shares = [F.percentile_approx(n, [i / bins for i in range(1, bins)], 2000).alias(n) for n in names]
    # quantiles of either class: those of the rare one matter as much
    got = rows.where("NOT prune").groupBy("bad").agg(*shares).collect()
    if not any(r["bad"] for r in got):
        return []
    thresholds = [sorted({int(v) + d for r in got for v in r[n] or () for d in (0, 1)}) for n in names]
    binned = scratch.write(rows.select("*", *[
        F.expr(f"size(filter(array({', '.join(f'{t}L' for t in cuts)}), t -> t <= {n}))").alias(f"b_{n}")
        for n, cuts in zip(names, thresholds, strict=True)]), "binned")
    rules: list[Rule] = []
    open_rows = binned
    while len(rules) < max_rules:
        grow = open_rows.where("NOT prune")
        rule: Rule = ()
        while len(rule) < max_conditions:
            hist, p0, n0 = _histogram(grow.where(_all(rule)), names)
            best = _best(hist, thresholds, p0, n0) if p0 >= min_rows and n0 else None
            if best is None:
                break
            rule = (*rule, Condition(names[best[1]], best[2], best[3]))
            if best[5] == 0:
                break
        if not rule:
            break
        held = open_rows.where("prune").agg(*[
            F.sum((_all(rule[:k]) & (F.col("bad") == side)).cast("long")).alias(f"{'p' if side else 'n'}{k}")
            for k in range(1, len(rule) + 1) for side in (True, False)]).first()
        scores = [((held[f"p{k}"] or 0) - (held[f"n{k}"] or 0)) / max(1, (held[f"p{k}"] or 0) + (held[f"n{k}"] or 0)) for k in range(1, len(rule) + 1)]
        k = max(range(len(rule)), key=lambda i: (scores[i], -i)) + 1
        p, n = held[f"p{k}"] or 0, held[f"n{k}"] or 0
        if p < max(1, min_rows // 2) or p / (p + n) < min_precision:
            break
        rules.append(rule[:k])
        open_rows = open_rows.where(~_all(rule[:k]))
    scratch.drop(rows, binned)
    return rules


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``kept``: false where the base rules failed, else the decision list's verdict."""
    return stats.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))


def keep(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``docs`` without the rejected documents, in one pass and without a shuffle.  The row number
    is there to be read by the filter: Spark pushes no filter below an expression that is not
    deterministic, and below this one it would repeat the statistics in every place that a
    rule names them."""
    stats = with_statistics(docs).withColumn("_row", F.monotonically_increasing_id())
    return judged(stats, rules).where("kept AND _row >= 0").select("row.*")
