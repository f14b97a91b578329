"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix
filters, joined on prefix n-grams and verified once per pair; links become components.

A document's set holds the 64-bit hashes of its distinct n-word shingles (words lower-cased
A-Z); with fewer than n words the whole sequence is one shingle, without words the set is
empty and linked with nothing.  Two sets link when ``100 * |x & y| >= percent * |x | y|``.

1. *Profile* (one pass): size and identity of every set, and how often each of 2^20 hash
   buckets occurs over all documents.  The bucket counts (1 MB whatever the input) order the
   shingles rare-first.  Any order gives the same links; this one keeps passages that many
   documents share out of the prefixes.
2. *Prefix join* (second pass): a set's rarest ``n - ceil(t n) + 1`` shingles go to the
   partitions of their keys; linked sets share one of them.  Equal sets enter once per task.
   Sorted partitions are streamed, and a set stays in a shingle's group only if it may link there.
3. *Rounds*: in each shingle's group every set is compared with its neighbour and with the
   first set, in a new order each round, so a group of copies costs its size, not its square.
   Candidates pass the length and positional filters, and the suffix filter (parities in 1024
   hash ranges bound how far two sets differ); of what is left, each set's nearest pair by
   these parities is verified exactly, once per pair.  Links become components.
4. *Rest*: all pairs of a group that are still in different components and pass the filters
   are verified as well, so no link between components is missed.

Documents with a null id get a set size but no component.  Rows that share an id are one
document for linking: it has the links of each of its texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandflow.llm.common import Scratch, mix, slices, window_hashes, word_hashes
from demandflow.llm.graph import components

BUCKETS = 1 << 20
SLICE = 1 << 12
SLICE_BYTES = 1 << 20  # of text whose shingles are in memory at once
PARTS = 1024
WORDS = PARTS // 64


def sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, offsets = word_hashes(texts)
    grams = window_hashes(words, n)
    out = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            out.append(mix(window_hashes(words[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(grams[:0])
    return out


def identity(s: np.ndarray) -> int:
    """64-bit identity of a set, from two independent folds of its elements."""
    with np.errstate(over="ignore"):
        h = mix(s ^ np.uint64(0x5851F42D4C957F2D))
        folds = np.array([h.sum(dtype=np.uint64), np.bitwise_xor.reduce(h) + np.uint64(len(s))], np.uint64)
        return int(mix(mix(folds[:1]) ^ folds[1:]).view(np.int64)[0])


def profile(docs: DataFrame, n: int) -> DataFrame:
    """``doc_id, n, sid, mark`` per document (slice null; mark: a hash of the text) and
    ``slice, counts`` per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                own = sets(part.column("text"), n)
                rows = len(own)
                every = np.concatenate(own) if own else np.zeros(0, np.uint64)
                counts += np.bincount((every & np.uint64(BUCKETS - 1)).astype(np.int64), minlength=BUCKETS)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column("doc_id"), "n": pa.array([len(s) for s in own], pa.int64()),
                    "sid": pa.array([identity(s) if len(s) else None for s in own], pa.int64()), "mark": part.column("mark"),
                    "slice": pa.nulls(rows, pa.int32()), "counts": pa.nulls(rows, pa.binary())})
        parts = [(i, counts[i * SLICE:(i + 1) * SLICE]) for i in range(BUCKETS // SLICE)]
        parts = [(i, zlib.compress(c.astype("<u4").tobytes(), 1)) for i, c in parts if c.any()]
        empty = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_pydict({
            "doc_id": empty, "n": empty, "sid": empty, "mark": empty, "slice": pa.array([i for i, _ in parts], pa.int32()),
            "counts": pa.array([c for _, c in parts], pa.binary())})

    return _marked(docs).mapInArrow(run, "doc_id long, n long, sid long, mark long, slice int, counts binary")


def _marked(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("mark"))


def rarity(profiled: DataFrame) -> np.ndarray:
    """Rank of each bucket's total count, in 256 logarithmic steps (1 MB).  Slices are summed
    in a stream, so a task holds one running total per slice."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                c = np.frombuffer(zlib.decompress(blob), "<u4").astype(np.int64)
                totals[i] = totals[i] + c if i in totals else c
        if totals:
            yield pa.RecordBatch.from_pydict({"slice": pa.array(list(totals), pa.int32()),
                                              "counts": pa.array([c.tobytes() for c in totals.values()], pa.binary())})

    rows = profiled.where("slice IS NOT NULL").select("slice", "counts").repartition(32, "slice")
    counts = np.zeros(BUCKETS, np.int64)
    for r in rows.mapInArrow(add, "slice int, counts binary").collect():  # BUCKETS numbers in all
        counts[r["slice"] * SLICE:(r["slice"] + 1) * SLICE] += np.frombuffer(r["counts"], "<i8")
    return np.minimum(255, 6 * np.log2(1 + counts)).astype(np.uint8)


def _share(size: int, percent: int) -> int:
    return -(-percent * size // 100)


def prefixes(docs: DataFrame, ranks: np.ndarray, n: int, percent: int) -> DataFrame:
    """``key, n, sid, pos``: the rarest shingles of every set, equal sets once per task."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = shared.value, set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                keys, sizes, sids, lens = [], [], [], []
                for s in sets(part.column("text"), n):
                    sid = identity(s) if len(s) else None
                    if sid is None or sid in seen:
                        continue
                    seen.add(sid)
                    key = (rank[s & np.uint64(BUCKETS - 1)].astype(np.uint64) << np.uint64(56)) | (s >> np.uint64(8))
                    take = len(s) - _share(len(s), percent) + 1
                    keys.append(np.sort(np.partition(key, take - 1)[:take] if take < len(s) else key))
                    sizes.append(len(s))
                    sids.append(sid)
                    lens.append(take)
                if not keys:
                    continue
                lens = np.array(lens)
                pos = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(np.concatenate(keys).view(np.int64)), "n": pa.array(np.repeat(np.array(sizes, np.int32), lens)),
                    "sid": pa.array(np.repeat(np.array(sids, np.int64), lens)), "pos": pa.array(pos.astype(np.int32))})

    return docs.where("doc_id IS NOT NULL").select(F.col("text").cast("string")).mapInArrow(run, "key long, n int, sid long, pos int")


#: Groups of at most this many sets are compared pair by pair while they stream past.
SMALL = 256


def _shared_rows(percent: int):
    """Of rows sorted by (key, n, sid): each (key, sid) once, and only those that may link with
    another set of their key.  In a small group that is decided by the length and positional filter
    of every pair.  In a larger one a row stays if its neighbour is near enough in size: sizes rise
    within a key, so a set with any possible partner there has one next to it.  No more than a
    small group, or the last row of a larger one, waits for the next batch."""
    names = ["key", "n", "sid", "pos"]

    def neighbours(rows: list[np.ndarray]) -> np.ndarray:
        """Whether each row is near enough in size to the next one."""
        n = rows[1].astype(np.int64)
        return (rows[0][1:] == rows[0][:-1]) & (100 * n[:-1] >= percent * n[1:])

    def small_groups(rows: list[np.ndarray], starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each row of a small group may link with another one."""
        n, pos = rows[1].astype(np.int64), rows[3].astype(np.int64)
        ok = np.zeros(len(n), bool)
        after = np.repeat(starts + sizes, sizes) - np.arange(len(n))  # rows from here to the group's end
        at = np.flatnonzero(np.repeat(sizes <= SMALL, sizes))
        for d in range(1, SMALL):
            at = at[after[at] > d]
            if not len(at):
                break
            x, y = n[at], n[at + d]
            link = (100 * x >= percent * y) & ((100 + percent) * np.minimum(x - pos[at], y - pos[at + d]) >= percent * (x + y))
            ok[at[link]] = True
            ok[at[link] + d] = True
            at = at[100 * x >= percent * y]  # sizes only rise: beyond this one none is near enough
        return ok

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        big: int | None = None  # key of a large group whose first rows are gone
        before = False          # the held row of such a group may link with the one before it
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            new = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[2][1:] != rows[2][:-1])]
            rows = [c[new] for c in rows]
            key = rows[0]
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            sizes = np.diff(np.r_[starts, len(key)])
            large = sizes > SMALL
            large[0] |= big is not None and key[0] == big
            near = neighbours(rows)
            ok = np.where(np.repeat(large, sizes), np.r_[before, near] | np.r_[near, False], small_groups(rows, starts, sizes))
            cut = len(key) - 1 if large[-1] else starts[-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[:cut][ok[:cut]]) for c in rows], names=names)
            held = [c[cut:] for c in rows]
            if large[-1]:
                before, big = bool(near[-1]) if len(near) else before, int(key[-1])
            else:
                before, big = False, None
        if held is not None:
            ok = np.array([before]) if big is not None else small_groups(held, np.zeros(1, np.int64), np.array([len(held[0])]))
            yield pa.RecordBatch.from_arrays([pa.array(c[ok]) for c in held], names=names)

    return run


def _sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the set's counts in PARTS hash ranges, as words of 64 bits."""
    odd = np.bincount((s >> np.uint64(54)).astype(np.int64), minlength=PARTS) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def _numbered(texts: DataFrame, n: int) -> DataFrame:
    """``sid, text`` of every ``text`` with words, equal sets once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sids = [identity(s) if len(s) else None for s in sets(part.column("text"), n)]
                new = _first_of_each(sids, seen)
                yield pa.RecordBatch.from_pydict({"sid": pa.array(sids, pa.int64()), "text": part.column("text")}).filter(new)

    return texts.select("text").mapInArrow(run, "sid long, text string")


def _first_of_each(sids: list[int | None], seen: set[int]) -> pa.Array:
    """Whether each of ``sids`` is neither null nor seen before; ``seen`` grows with them."""
    new = []
    for sid in sids:
        new.append(sid is not None and sid not in seen)
        seen.add(sid)
    return pa.array(new, pa.bool_())


def member_sets(texts: DataFrame, n: int) -> DataFrame:
    """``sid, size, z0 ..., items`` per set of ``sid, text``, dealt by ``sid``: the sketch and the
    sorted hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            batch = batch.filter(_first_of_each(batch.column("sid").to_pylist(), seen))
            for part in slices(batch, "text", SLICE_BYTES):
                own = sets(part.column("text"), n)
                z = np.array([_sketch(s) for s in own], np.int64).reshape(len(own), WORDS)
                yield pa.RecordBatch.from_pydict({
                    "sid": part.column("sid"), "size": pa.array([len(s) for s in own], pa.int32()),
                    **{f"z{i}": pa.array(z[:, i]) for i in range(WORDS)},
                    "items": pa.array([s.astype("<u8").tobytes() for s in own], pa.binary())})

    return texts.select("sid", "text").mapInArrow(run, f"sid long, size int, {', '.join(f'z{i} long' for i in range(WORDS))}, items binary")


BITS = 27
_WORD = 15


def bitmap(keys: DataFrame, count: int) -> tuple[np.ndarray, int]:
    """Bits of the ``h`` of all rows, about 16 a row, at most 2^27 (16 MB whatever the input), and
    how many bits of a hash they are."""
    bits = min(BITS, max(_WORD, (16 * count).bit_length()))
    at = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))

    def pack(group: pa.Table) -> pa.Table:
        p = group.column("p").to_numpy()
        word = np.zeros(1 << _WORD, np.uint8)
        word[p & ((1 << _WORD) - 1)] = 1
        return pa.table({"slice": pa.array([int(p[0]) >> _WORD], pa.int64()), "b": pa.array([np.packbits(word).tobytes()], pa.binary())})

    rows = keys.select(at.alias("p")).distinct().groupBy(F.shiftright("p", _WORD)).applyInArrow(pack, "slice long, b binary")
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.collect():  # 2^bits bits in all
        out[r["slice"] << (_WORD - 3):(r["slice"] + 1) << (_WORD - 3)] = np.frombuffer(r["b"], np.uint8)
    return out, bits


def maybe(spark: SparkSession, h: Column, found: np.ndarray, bits: int) -> Column:
    """Whether the hash ``h`` may be among the bitmap's.  Only ``h`` goes to Python."""
    shared = spark.sparkContext.broadcast(found)

    @F.pandas_udf("boolean")
    def hit(values: pd.Series) -> pd.Series:
        at = values.to_numpy() & ((1 << bits) - 1)
        return pd.Series((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1)

    return hit(h)


def _renamed(members: DataFrame, key: str, mark: str) -> DataFrame:
    return members.select(F.col("sid").alias(key), F.col("size").alias(f"size_{mark}"), *[F.col(f"z{i}").alias(f"z{i}_{mark}") for i in range(WORDS)])


_APART = " + ".join(f"bit_count(z{i}_x ^ z{i}_y)" for i in range(WORDS))


def _close(percent: int) -> str:
    """Suffix filter: sets that link differ in at most ``(100 - p) / (100 + p)`` of their sizes'
    sum, and every hash range of odd difference holds at least one element of one set only."""
    return f"{100 + percent} * ({_APART}) <= {100 - percent} * (size_x + size_y)"


def _needed(pairs: DataFrame, members: DataFrame, columns: list[str], scratch: Scratch, name: str) -> DataFrame:
    """``columns`` of the sets that occur in ``pairs``.  The bucketed sets stay where they are,
    only ids move; written, so that the joins that follow can split a set with many pairs."""
    ids = pairs.select(F.col("a").alias("sid")).unionByName(pairs.select(F.col("b").alias("sid"))).distinct()
    return scratch.write(members.select("sid", *columns).join(ids.hint("shuffle_hash"), "sid", "left_semi"), name)


def _nearest(near: DataFrame) -> DataFrame:
    """Of ``near`` the pair of each set whose sketches differ least."""
    ends = [near.select(F.col(x).alias("sid"), F.struct("apart", F.col(y).alias("other")).alias("to")) for x, y in ("ab", "ba")]
    best = ends[0].unionByName(ends[1]).groupBy("sid").agg(F.min("to").alias("to"))
    return best.select(F.least("sid", "to.other").alias("a"), F.greatest("sid", "to.other").alias("b")).distinct()


#: Sets with more pairs than this are moved by joins that can split them.
BUSY = 256


def _both_sets(near: DataFrame, members: DataFrame, scratch: Scratch) -> tuple[DataFrame, list[DataFrame]]:
    """``a, b, x, y``: the items of both sets of each pair, and the tables this reads.  The bucketed
    sets stay where they are, but for one of each pair, which moves to the other one's bucket."""
    ends = near.select(F.col("a").alias("sid")).unionByName(near.select(F.col("b").alias("sid")))
    busy = scratch.write(ends.groupBy("sid").agg(F.count(F.lit(1)).alias("n")).where(f"n > {BUSY}").select("sid"), "busy")
    columns = ["p.a", "p.b", F.col("x.items").alias("x"), F.col("y.items").alias("y")]

    def joined(pairs: DataFrame, whole: DataFrame) -> DataFrame:
        moved = pairs.alias("p").join(whole.alias("x"), F.expr("p.a = x.sid"))
        return moved.join(whole.alias("y"), F.expr("p.b = y.sid")).select(*columns)

    items = members.select("sid", "items")
    if not busy.limit(1).count():
        return joined(near, items), [busy]
    a, b = (busy.select(F.col("sid").alias(x), F.lit(True).alias(f"busy_{x}")) for x in "ab")
    marked = near.select("a", "b").join(a, "a", "left").join(b, "b", "left").withColumn("busy", F.expr("busy_a IS NOT NULL OR busy_b IS NOT NULL"))
    marked = scratch.write(marked.select("a", "b", "busy"), "marked")
    crowded = marked.where("busy").select("a", "b")
    # written, so that its joins can split a set with many pairs; both read one exchange of it
    whole = _needed(crowded, members, ["items"], scratch, "whole")
    return joined(marked.where("NOT busy"), items).unionByName(joined(crowded, whole)), [busy, marked, whole]


def verified(pairs: DataFrame, members: DataFrame, percent: int, scratch: Scratch, nearest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The pairs ``a, b`` that link and all that were tested, written: first the suffix filter, then
    the sets themselves.  With ``nearest``, of the pairs that pass the filter only the nearest one
    of each set is tested now, so no more sets move than there are."""
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    sketches = _needed(pairs, members, ["size", *[f"z{i}" for i in range(WORDS)]], scratch, "sketches")
    near = pairs.join(_renamed(sketches, "a", "x"), "a").join(_renamed(sketches, "b", "y"), "b").where(_close(percent))
    near = scratch.write(near.select("a", "b", F.expr(f"({_APART}) / (size_x + size_y)").alias("apart")), "near")
    scratch.drop(sketches)
    tested = pairs
    if nearest:
        every, near = near, scratch.write(_nearest(near), "nearest")
        later = every.join(near, ["a", "b"], "left_anti")
        tested = scratch.write(pairs.join(later, ["a", "b"], "left_anti"), "tested")
        scratch.drop(every, pairs)
    both, used = _both_sets(near, members, scratch)
    out = scratch.write(both.mapInArrow(exact, "a long, b long"), "links")
    scratch.drop(near, *used)
    return out, tested


def _possible(percent: int) -> str:
    """Length and positional filter for rows with sizes ``n, m`` and positions ``pos, qos``: the
    first shared prefix shingle of two sets that link always passes."""
    return (f"100 * least(n, m) >= {percent} * greatest(n, m) AND "
            f"{100 + percent} * least(n - pos, m - qos) >= {percent} * (n + m)")


def links(docs: DataFrame, scratch: Scratch, n: int = 5, percent: int = 80, rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """``doc_id, n, sid`` per row of ``docs`` and ``node, component`` per linked set."""
    with scratch.small_batches():
        return _links(docs, scratch, n, percent, rounds)


def _links(docs: DataFrame, scratch: Scratch, n: int, percent: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    profiled = scratch.write(profile(docs, n), "profile")
    rows = profiled.where("slice IS NULL").select("doc_id", "n", "sid", "mark")
    with scratch.released():
        ranks = rarity(profiled)
    dealt = prefixes(docs, ranks, n, percent).repartition("key").sortWithinPartitions("key", "n", "sid")
    groups = scratch.write_bucketed(dealt.mapInArrow(_shared_rows(percent), "key long, n int, sid long, pos int"), "groups", "key")
    # one row per set first, so that a large class of copies moves as one row
    named = rows.where("doc_id IS NOT NULL AND sid IS NOT NULL").groupBy("sid").agg(F.min(F.struct("doc_id", "mark")).alias("x"))
    named = named.join(groups.select("sid").distinct(), "sid", "left_semi")
    named = scratch.write(named.select("sid", "x.*", F.xxhash64("x.doc_id", "x.mark").alias("h")), "named")
    # a set's text travels, not its hashes, which take more room; most others stay where they are
    likely = _marked(docs).where("doc_id IS NOT NULL AND mark IS NOT NULL").withColumn("h", F.xxhash64("doc_id", "mark"))
    likely = likely.where(maybe(scratch.spark, F.col("h"), *bitmap(named, named.count())))
    # found again where the texts lie, the sets' ids let the texts move once, straight to their buckets
    texts = _numbered(likely, n).repartition("sid").join(named.select("sid"), "sid", "left_semi")
    members = scratch.write_bucketed(member_sets(texts, n), "members", "sid")
    # the texts of one id belong together
    same = rows.where("sid IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("sid").alias("u"), F.max("sid").alias("v")).where("u != v")
    if same.limit(1).count():
        first = rows.join(same.select("doc_id", "u"), "doc_id").where("sid != u")
        found = components(first.select("u", F.col("sid").alias("v")), scratch)
    else:
        found = None
    tried, k = None, 0
    while True:
        if found is None:  # the groups stay where they are
            now = groups.withColumn("c", F.col("sid"))
        else:
            now = groups.join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn("c", F.coalesce("component", "sid")).drop("component")
        one = Window.partitionBy("key")
        now = now.withColumn("lo", F.min("c").over(one)).withColumn("hi", F.max("c").over(one)).where("lo != hi").drop("lo", "hi")
        if k < rounds:
            turn = one.orderBy("n", "sid") if k == 0 else one.orderBy(F.xxhash64("sid", F.lit(k)), "sid")
            near = F.array(*[F.struct(*[f("sid").alias("other"), f("c").alias("d"), f("n").alias("m"), f("pos").alias("qos")])
                             for f in (lambda c, w=turn: F.lag(c).over(w), lambda c, w=turn: F.first(c).over(w))])
            pairs = now.withColumn("near", near).select("sid", "c", "n", "pos", F.explode("near").alias("x")).select("sid", "c", "n", "pos", "x.*")
            pairs = pairs.where("other IS NOT NULL AND c != d")
        else:
            # the largest component of a group needs no pairs within it
            many = now.groupBy("key", "c").agg(F.count(F.lit(1)).alias("size")).groupBy("key").agg(F.max_by("c", F.struct("size", "c")).alias("main"))
            now = now.join(many, "key")
            other = now.select("key", F.col("sid").alias("other"), F.col("c").alias("d"), F.col("n").alias("m"), F.col("pos").alias("qos"))
            other = other.join(_renamed(members, "other", "y"), "other")
            now = now.where("c != main").join(_renamed(members, "sid", "x"), "sid")
            pairs = now.join(other, "key").where("c != d AND (d = main OR sid < other)").where(_close(percent))
        pairs = pairs.where(_possible(percent)).select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        new, tested = verified(scratch.write(pairs, "pairs"), members, percent, scratch, nearest=k < rounds)
        tried = tested if tried is None else tried.unionByName(tested)
        new = new.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if new.limit(1).count():
            if found is not None:
                new = new.unionByName(found.select(F.col("node").alias("u"), F.col("component").alias("v")))
            found = scratch.write(components(new, scratch), "found")
            if k < rounds:
                k += 1
                continue
        if k >= rounds:
            scratch.drop(members, groups, named)
            if found is None:
                found = scratch.spark.createDataFrame([], "node long, component long")
            return rows.drop("mark"), found
        k = rounds  # a round without a link: only the rest is left


def clusters(docs: DataFrame, scratch: Scratch, n: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per row of ``docs``."""
    rows, found = links(docs, scratch, n, percent)
    rows = rows.join(found.withColumnRenamed("node", "sid"), "sid", "left").withColumn("c", F.coalesce("component", "sid"))
    # the smallest id per class first, so that a huge class is one aggregated row
    least = rows.where("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("least"))
    out = rows.join(least, "c", "left")
    # an id with several texts, some of them without words, belongs where its words are
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
