"""URL filter: explicit rules first, else a Bloom filter cascade over hosts.

The cascade is exact on the corpus's complete universe of hosts.  Level 0 is a Bloom filter of
the listed hosts; level 1 one of those unlisted hosts of the universe that level 0 accepts;
level 2 one of the listed hosts that level 1 accepts, and so on until a level accepts nothing
wrongly.  A host is listed if the first level that rejects it is odd (or if none rejects it
and the last level encodes listed hosts).  Rows are judged against the filters alone: no join,
no shuffle.

The universe is split by hash into shards of about ``shard_keys`` hosts, and each shard's
cascade is built by one task.  The filters are applied in blocks of at most ``block_bytes``;
with more than one block the rows are written between passes, so that one block is broadcast at
a time.

Null URLs and URLs without ``://`` have the empty host and path (the empty host is a key like
any other).  Repeated rows are judged alike; of rules of equal length the smaller text wins;
empty tables and an empty list give no blocked row.  Extra columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm.common import Scratch, mix

Rule = tuple[str, str, str]  # verdict, host, path
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_parts(pages: DataFrame) -> DataFrame:
    """Adds ``host`` (after the first ``://`` up to ``/?#``, A-Z lower-cased) and ``path`` (then up to ``?#``)."""
    rest = F.expr("if(instr(url, '://') > 0, substr(url, instr(url, '://') + 3), '')")
    df = pages.withColumn("_rest", F.coalesce(rest, F.lit("")))
    df = df.withColumn("host", F.translate(F.regexp_extract("_rest", "^[^/?#]*", 0), _UPPER, _LOWER))
    return df.withColumn("path", F.regexp_extract("_rest", "^[^/?#]*([^?#]*)", 1)).drop("_rest")


def rule_of(rules: list[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (host and path as one text) and its verdict, or null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), [-ord(c) for c in r[1] + r[2]])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        text, verdict = F.when(fits, F.lit(host + path)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


class Bloom:
    """A Bloom filter of 64-bit key hashes, seeded by its level."""

    def __init__(self, bits: np.ndarray, size: int, hashes: int, level: int):
        self.bits, self.size, self.hashes, self.level = bits, size, hashes, level

    def _places(self, keys: np.ndarray) -> Iterator[np.ndarray]:
        with np.errstate(over="ignore"):
            h = mix(keys + np.uint64(self.level) * np.uint64(0x9E3779B97F4A7C15))
            step = mix(h) | np.uint64(1)
            for j in range(self.hashes):
                yield ((h + np.uint64(j) * step) % np.uint64(self.size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray, rate: float, level: int) -> Bloom:
        size = max(64, math.ceil(-len(keys) * math.log(rate) / math.log(2) ** 2))
        out = cls(np.zeros(size, bool), size, max(1, round(size / len(keys) * math.log(2))), level)
        for at in out._places(keys):
            out.bits[at] = True
        out.bits = np.packbits(out.bits)
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), bool)
        for at in self._places(keys):
            ok &= (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
        return ok


def build(listed: np.ndarray, unlisted: np.ndarray) -> list[Bloom]:
    """The cascade of two disjoint arrays of key hashes."""
    if len(np.intersect1d(listed, unlisted)):
        raise ValueError("listed and unlisted keys share a hash")
    levels: list[Bloom] = []
    inside, outside = listed, unlisted
    # the first level is stricter where unlisted keys are many; the others halve what is left
    rate = min(0.5, len(listed) / (math.sqrt(2) * max(1, len(unlisted)))) if len(listed) else 0.5
    while len(inside):
        level = Bloom.of(inside, rate, len(levels))
        levels.append(level)
        inside, outside, rate = outside[level.has(outside)], inside, 0.5
    return levels


def listed_of(levels: list[Bloom], keys: np.ndarray) -> np.ndarray:
    """Whether each key of the universe is listed."""
    out, open_rows = np.zeros(len(keys), bool), np.arange(len(keys))
    for level in levels:
        accepted = level.has(keys[open_rows])
        out[open_rows[accepted]] = level.level % 2 == 0
        open_rows = open_rows[accepted]
    return out


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def cascade(universe: DataFrame, listed: DataFrame, scratch: Scratch, shard_keys: int = 200_000) -> tuple[DataFrame, int, DataFrame]:
    """``shard, level, size, hashes, bits`` for the distinct ``key`` of ``universe``, of which those in
    ``listed`` (``key``) are listed; the number of shards; and ``key, listed`` of the keys that share
    their hash with one of the other side, which no filter can tell apart (none, as a rule)."""
    keys = universe.select("key").distinct().join(listed.select("key").distinct().withColumn("listed", F.lit(True)), "key", "left")
    shards = max(1, -(-universe.select("key").distinct().count() // shard_keys))
    keys = keys.select("key", _hash(F.col("key")).alias("h"), F.coalesce("listed", F.lit(False)).alias("listed"),
                       _shard(F.col("key"), shards).alias("shard"))
    both = keys.groupBy("h", "shard").agg(F.min("listed").alias("lo"), F.max("listed").alias("hi")).where("lo != hi").select("h", "shard")
    odd = scratch.write(keys.join(both, ["h", "shard"]).select("key", "listed"), "odd")
    keys = keys.join(odd.select("key"), "key", "left_anti").drop("key")

    def run(rows: pa.Table) -> pa.Table:
        h = rows.column("h").to_numpy().view(np.uint64)
        is_listed = rows.column("listed").to_numpy()
        levels = build(h[is_listed], h[~is_listed])
        shard = rows.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard] * len(levels), pa.int64()), "level": pa.array([x.level for x in levels], pa.int64()),
                         "size": pa.array([x.size for x in levels], pa.int64()), "hashes": pa.array([x.hashes for x in levels], pa.int64()),
                         "bits": pa.array([x.bits.tobytes() for x in levels], pa.binary())})

    return keys.groupBy("shard").applyInArrow(run, "shard long, level long, size long, hashes long, bits binary"), shards, odd


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(shards)).cast("long")


def _blocks(filters: DataFrame, block_bytes: int) -> Iterator[dict[int, list[Bloom]]]:
    block: dict[int, list[Bloom]] = {}
    size = 0
    for r in filters.orderBy("shard", "level").toLocalIterator():
        if size and r["shard"] not in block and size + len(r["bits"]) > block_bytes:
            yield block
            block, size = {}, 0
        block.setdefault(r["shard"], []).append(Bloom(np.frombuffer(r["bits"], np.uint8), r["size"], r["hashes"], r["level"]))
        size += len(r["bits"])
    if block:
        yield block


def with_listed(rows: DataFrame, key: str, filters: DataFrame, shards: int, odd: DataFrame, scratch: Scratch,
                block_bytes: int = 32_000_000) -> DataFrame:
    """Adds ``listed``: whether the row's key, which must be in the universe, is listed.  The other
    columns must not be named like the helpers ``_h, _shard, _odd``."""
    spark = rows.sparkSession
    out = rows.withColumn("_h", _hash(F.col(key))).withColumn("_shard", _shard(F.col(key), shards)).withColumn("listed", F.lit(False))
    schema = T.StructType(out.schema.fields)

    def judged(df: DataFrame, block: dict[int, list[Bloom]]) -> tuple[DataFrame, object]:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index
                shard = batch.column(at("_shard")).to_numpy()
                keys = batch.column(at("_h")).to_numpy().view(np.uint64)
                got = batch.column(at("listed")).to_numpy(zero_copy_only=False).copy()
                for s in np.unique(shard).tolist():
                    if s in shared.value:
                        own = np.flatnonzero(shard == s)
                        got[own] = listed_of(shared.value[s], keys[own])
                yield batch.set_column(at("listed"), "listed", pa.array(got))

        return df.mapInArrow(run, schema), shared

    before = None
    for block in _blocks(filters, block_bytes):
        if before is not None:  # the pass before ends here, and its block goes
            out = scratch.write(out, "judged")
            before.unpersist()
        out, before = judged(out, block)
    if odd.limit(1).count():
        out = out.join(odd.select(F.col("key").alias(key), F.col("listed").alias("_odd")), key, "left")
        out = out.withColumn("listed", F.coalesce("_odd", "listed")).drop("_odd")
    return out.drop("_h", "_shard")


def judge(pages: DataFrame, listed: DataFrame, rules: list[Rule], scratch: Scratch, shard_keys: int = 200_000,
          block_bytes: int = 32_000_000) -> DataFrame:
    """``row`` (a struct of the columns of ``pages``, so that no name can clash), ``host, path, rule`` and
    ``verdict`` (allow or block); ``listed`` holds the hosts to block as ``key``."""
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col("url").cast("string").alias("url"))
    rows = with_parts(rows).drop("url")
    filters, shards, odd = cascade(rows.select(F.col("host").alias("key")), listed, scratch, shard_keys)
    filters = scratch.write(filters, "filters")
    text, verdict = rule_of(rules)
    rows = with_listed(rows.withColumn("rule", text).withColumn("_verdict", verdict), "host", filters, shards, odd, scratch, block_bytes)
    verdict = F.coalesce("_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("row", "host", "path", "rule", verdict.alias("verdict"))
