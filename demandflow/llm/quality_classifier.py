"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(threshold_k - w . x)`` with thresholds in increasing order and one
weight vector for all of them.  Features are the presence of hashed lower-cased words and the
binned shares of words with symbols, of upper-case words, of distinct words, and the length,
hashed into the same space.  The fit takes at most ``sample_rows`` rated documents (those with
the smallest hash of their id); scoring reads all documents in one pass, with a weight table
of fixed size broadcast, and gives the expected grade and the tail probability of the top
grade for selection.

Null and empty texts have only the length feature.  Repeated ratings of a document count each,
ratings without a grade or a document are left out, and with fewer than two grades all scores
are those of the grade there is.  An empty table gives an empty result.  Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import slices, word_lists

BITS = 18
SYMBOLS = frozenset("#*$%&|<>!")


def _slot(name: str) -> int:
    return xxhash.xxh3_64_intdigest(name) & ((1 << BITS) - 1)


_SHARES = {k: np.array([_slot(f"\x00{k}:{b}") for b in range(41)]) for k in ("symbols", "upper", "distinct", "length")}


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slots of every text, flat and distinct within a text, with the offsets of each."""
    flat, offsets = word_lists(texts, lower=False)
    n = len(offsets) - 1
    size = np.diff(offsets)
    row = np.repeat(np.arange(n), size)
    length = _SHARES["length"][np.minimum(40, (2 * np.log2(1 + size)).astype(np.int64))]
    if not len(flat):
        return length, np.arange(n + 1)
    coded = flat.dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy()
    slot = np.fromiter((_slot(w.lower().strip(".,;:!?")) for w in words), np.int64, len(words))
    marked = np.fromiter((not SYMBOLS.isdisjoint(w) for w in words), bool, len(words))
    upper = np.fromiter((w.isupper() and len(w) > 1 for w in words), bool, len(words))
    pairs = np.unique((row << BITS) | slot[codes])
    distinct = np.bincount(pairs >> BITS, minlength=n)
    some = np.flatnonzero(size)
    extra = [(np.arange(n) << BITS) | length]
    for name, count in (("symbols", np.bincount(row, marked[codes], n)), ("upper", np.bincount(row, upper[codes], n)), ("distinct", distinct)):
        extra.append((some << BITS) | _SHARES[name][(20 * count[some] / size[some]).astype(np.int64)])
    pairs = np.unique(np.concatenate([pairs, *extra]))
    return pairs & ((1 << BITS) - 1), np.r_[0, np.cumsum(np.bincount(pairs >> BITS, minlength=n))]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # increasing; grades are low + 0 ... low + len(thresholds)
    low: int

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > low + k) per row and threshold."""
        return 1 - _sigmoid(self.thresholds[None, :] - score[:, None])

    def score(self, slots: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(self.weights[slots], dtype=np.float64)]
        return total[offsets[1:]] - total[offsets[:-1]]


def fit(slots: list[np.ndarray], grades: np.ndarray, min_docs: int = 10, l2: float = 2e-4, steps: int = 250, rate: float = 0.1) -> Model:
    """Adam on the mean negative log-likelihood; weights of slots in fewer than ``min_docs`` texts stay 0."""
    low, levels = (int(grades.min()), int(grades.max() - grades.min())) if len(grades) else (0, 0)
    weights = np.zeros(1 << BITS)
    if levels == 0:
        return Model(weights, np.zeros(0), low)
    flat = np.concatenate(slots)
    row = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    used = np.flatnonzero(np.bincount(flat, minlength=1 << BITS) >= min_docs)
    index = np.full(1 << BITS, -1)
    index[used] = np.arange(len(used))
    ok = index[flat] >= 0
    column, row = index[flat[ok]], row[ok]
    y = grades - low
    share = np.clip([(y <= k).mean() for k in range(levels)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(np.log(share / (1 - share)) + 1e-3 * np.arange(levels))
    # thresholds as a first one and logarithms of the steps between them, so they stay ordered
    theta = np.r_[np.zeros(len(used)), start[:1], np.log(np.maximum(np.diff(start), 1e-3))]
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = len(y)
    for t in range(1, steps + 1):
        w, first, gaps = theta[:len(used)], theta[len(used)], np.exp(theta[len(used) + 1:])
        cut = first + np.r_[0, np.cumsum(gaps)]
        score = np.bincount(row, w[column], n)
        upto = np.c_[np.zeros(n), _sigmoid(cut[None, :] - score[:, None]), np.ones(n)]
        hi, lo = upto[np.arange(n), y + 1], upto[np.arange(n), y]
        p = np.maximum(hi - lo, 1e-12)
        d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p  # of log p by the upper and the lower cut
        g_score = (d_hi - d_lo) / n
        g_cut = np.zeros(levels + 2)
        np.add.at(g_cut, y + 1, -d_hi / n)
        np.add.at(g_cut, y, d_lo / n)
        g_cut = g_cut[1:-1]
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = np.r_[np.bincount(column, g_score[row], len(used)) + l2 * w, tail[:1], tail[1:] * gaps]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights[used] = theta[:len(used)]
    return Model(weights, theta[len(used)] + np.r_[0, np.cumsum(np.exp(theta[len(used) + 1:]))], low)


def train(docs: DataFrame, ratings: DataFrame, sample_rows: int = 8000, **options) -> Model:
    """A model of ``ratings`` (``doc_id, grade``) of ``docs`` (``doc_id, text``).  It is fitted on at most
    ``sample_rows`` ratings, those with the smallest hash of their id, and, as an id may stand on
    many rows, on at most twice as many of their rows, those with the smallest hash of id and
    text: the same rows however the tables are partitioned."""
    rated = ratings.where("doc_id IS NOT NULL AND grade IS NOT NULL").select(F.col("doc_id").cast("long"), F.col("grade").cast("long"))
    sample = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample_rows)
    # at most sample_rows short rows, so they may be broadcast
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                slots, at = features(part.column("text"))
                yield pa.RecordBatch.from_pydict({"h": part.column("h"), "grade": part.column("grade"), "slots": pa.array(
                    [slots[a:b].astype("<i4").tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())})

    # a hot id may stand on many rows: the bound holds for rows as well
    rows = texts.select(F.xxhash64("doc_id", "text").alias("h"), "grade", "text").mapInArrow(run, "h long, grade long, slots binary")
    rows = rows.orderBy("h", "grade", "slots").limit(2 * sample_rows).collect()
    return fit([np.frombuffer(r["slots"], "<i4") for r in rows], np.array([r["grade"] for r in rows], np.int64), **options)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, expected_grade, tail_probability`` (of the top grade) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.thresholds, model.low))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                above = model.above(model.score(*features(part.column("text"))))
                tail = above[:, -1] if above.shape[1] else np.ones(part.num_rows)
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "expected_grade": pa.array(model.low + above.sum(axis=1)),
                                                  "tail_probability": pa.array(tail)})

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
