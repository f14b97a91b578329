"""Shared plumbing of the training-data operators: tables, scratch folder, word hashing."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words are maximal runs of anything but these ASCII white-space characters.
SPACE = r"[\x20\x09-\x0D]+"

#: Bytes of rows that go to Python at once where :meth:`Scratch.small_batches` holds.
BATCH_BYTES = 4 << 20

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.  Where it is unset, a local session
    (one JVM, as in tests) gets a temporary folder and any other master is refused, because
    executors would not see the driver's disk."""
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="demandflow-llm-"))
    return sc.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage.  They are plain Parquet, so a
    lost executor costs no recomputation.  ``drop`` removes what is no longer read; the rest
    goes when the driver ends."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self._end)

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{name}-{self._n}"

    @contextmanager
    def _set(self, name: str, value: str) -> Iterator[None]:
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, value)
        try:
            yield
        finally:
            if before is None:
                self.spark.conf.unset(name)
            else:
                self.spark.conf.set(name, before)

    @contextmanager
    def released(self) -> Iterator[None]:
        """Shuffle files of what runs inside go when it ends: its result is a table by then."""
        with self._set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
            yield

    @contextmanager
    def small_batches(self, size: int = BATCH_BYTES) -> Iterator[None]:
        """What runs inside hands rows to Python and back in batches of about ``size`` bytes, however wide the
        rows are, so that neither the JVM nor a worker holds thousands of long texts or sets at once."""
        with self._set("spark.sql.execution.arrow.maxBytesPerBatch", str(size)):
            yield

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with self.released():
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def write_bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """A table bucketed by ``key`` into as many buckets as joins have partitions, so that
        joining small tables with it by ``key`` moves only those.  Rows of ``df`` should already
        be dealt by ``key``.  ``drop`` it when it is done with, as the catalog names it."""
        path, label = self.path(name), f"scratch_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with self.released():
            df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, key).saveAsTable(label)
        out = self.spark.table(label)
        out._scratch_path, out._scratch_table = path, label
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Remove these tables."""
        for df in frames:
            if hasattr(df, "_scratch_table"):
                self.spark.sql(f"DROP TABLE IF EXISTS {df._scratch_table}")
            delete(self.spark, df._scratch_path)

    def _end(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # noqa: BLE001 - the JVM may already be gone when Python exits
            pass


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 4_000_000, max_rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Cut a record batch so that one slice holds about ``max_bytes`` of text (or one row), and at
    most ``max_rows`` rows."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part, rows = np.cumsum(size.astype(np.int64)) // max_bytes, np.arange(n) // max_rows
    starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (rows[1:] != rows[:-1])])
    for a, b in zip(starts, np.r_[starts[1:], n], strict=True):
        yield batch.slice(int(a), int(b - a))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit integers."""
    x = (x + _GOLD).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def word_lists(texts: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Words of each text, lower-cased (A-Z) or not, flat, with the offsets of each text."""
    t = pc.fill_null(texts, "")
    t = pc.ascii_lower(t) if lower else t
    lists = pc.ascii_split_whitespace(t)
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    empty = pc.equal(flat, "").to_numpy(zero_copy_only=False)
    if empty.any():
        kept = np.r_[0, np.cumsum(~empty)]
        flat, offsets = flat.filter(pa.array(~empty)), kept[offsets]
    return flat, offsets


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words' 64-bit hashes, each word's place among them, flat, and the offsets of each text."""
    flat, offsets = word_lists(texts)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), offsets
    enc = flat.dictionary_encode()
    uniq = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in enc.dictionary.to_pylist()), np.uint64, len(enc.dictionary))
    return uniq, enc.indices.to_numpy().astype(np.int64), offsets


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of each text, flat, with the offsets of each text."""
    uniq, codes, offsets = word_codes(texts)
    return uniq[codes], offsets


_BASE = np.uint64(0x2545F4914F6CDD1D)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hash of every k consecutive words, mixed; shorter input gives none."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h = h * _BASE + words[j:j + n]
    return mix(h)
