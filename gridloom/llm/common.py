"""What the text operators share: shared storage, byte words, hashing, Arrow helpers."""

from __future__ import annotations

import atexit
import ctypes
import functools
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Odd multiplier of the rolling polynomial over 64-bit word hashes, and its inverse modulo 2**64.
POLY = 0x9E3779B97F4A7C15
POLY_INV = pow(POLY, -1, 1 << 64)


#: Rows of texts that go to a Python worker at once: a default batch of 10,000 long texts takes much of an executor's memory.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session, or, in local mode only, a temporary one where it is unset."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="gridloom-shared-")
        sc.setCheckpointDir(found)
        atexit.register(_remove_local, found)
    return found


def _remove_local(path: str) -> None:
    import shutil

    shutil.rmtree(path, ignore_errors=True)


#: Folders that operators have written, in order.
_TABLES: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder's name in the shared folder. remove_tables() deletes it."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _TABLES.append(path)
    return path


def tables_so_far() -> int:
    return len(_TABLES)


def remove_tables(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Deletes the folders that operators have written, those after the first `since` and without the ones that `keep` reads. Results that still read them must have been stored before."""
    sc = spark.sparkContext
    read_by = keep.inputFiles() if keep is not None else []
    kept = [x for x in _TABLES[since:] if any(f"/{x.rsplit('/', 1)[1]}/" in f for f in read_by)]
    for name in _TABLES[since:]:
        if name not in kept:
            path = sc._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    _TABLES[since:] = kept


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage, survives lost executors. remove_tables() deletes it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def byte_words(text: str | None) -> list[bytes]:
    """Words [^\\x20\\x09-\\x0D]+ of the text as UTF-8; bytes.split() parts at just those six bytes."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: What a worker keeps from task to task, by the module that it belongs to.
CACHES: dict[str, dict] = {}


def worker_task(module: str):
    """For functions over Arrow batches: a reused worker gives up what other modules' tasks have kept, and at the end what is free."""

    def wrap(function):
        @functools.wraps(function)
        def run(batches, *args, **kwargs):
            for name, kept in CACHES.items():
                if name != module:
                    kept.clear()
            try:
                yield from function(batches, *args, **kwargs)
            finally:
                pa.default_memory_pool().release_unused()
                if sys.platform == "linux":
                    ctypes.CDLL(None).malloc_trim(0)

        return run

    return wrap


class Powers:
    """POLY**i and POLY**-i modulo 2**64, grown as texts need them."""

    def __init__(self) -> None:
        self.up, self.down = (np.ones(1, np.uint64) for _ in range(2))

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (POLY, POLY_INV))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hashes(hashes: np.ndarray) -> np.ndarray:
    """P with P[b] - P[a] = sum of hashes[i] * POLY**i for a <= i < b, modulo 2**64."""
    up, _ = POWERS.get(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the word spans [start, end), equal for equal words wherever they stand."""
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches, a few thousand at a time in Python, never a whole partition."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from zip(*(part.column(n).to_pylist() for n in names), strict=True)


def column(values, kind: pa.DataType) -> pa.Array:
    return pa.array(values, type=kind)


def crc_mod(column_name: str, n: int):
    """crc32 of the id as decimal text, modulo n."""
    return F.crc32(F.col(column_name).cast("string").cast("binary")) % n
