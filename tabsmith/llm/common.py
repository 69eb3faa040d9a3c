"""Shared helpers: input tables, the shared scratch folder, word hashing."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text splits into words at the six ASCII white-space characters only.
WORD_SEP = "[\\x20\\x09-\\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once a session, through Spark's own
    file distribution, so that they import it wherever the driver found it."""
    sc, name = spark.sparkContext, "tabsmith-code.zip"
    if name not in sc._python_includes:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        sc.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), name[:-4]), "zip", top, "tabsmith"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, file or folder of part files, through Spark's readers."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A folder of our own is taken only in local mode with the setting unset;
    on a cluster a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="tabsmith-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Spark's own switch: files of a query's shuffles go when the query is over.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows of an Arrow batch, and the most a batch of texts may hold here: a task has a batch
#: in the JVM's writer, in Python's reader and as pandas strings, all at once.
_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends
    there, so a lost executor costs no recomputation of what came before, and
    the files of the shuffles that made it are given up. Tasks in Python get batches of at
    most ``BATCH_ROWS`` rows meanwhile."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in (_CLEAN_UP, _BATCH)}
    rows = int(before[_BATCH] or 0)
    spark.conf.set(_CLEAN_UP, "true")
    spark.conf.set(_BATCH, str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Give up the files of a ``written`` table that has no reader left."""
    spark = df.sparkSession
    top, jvm = shared_dir(spark), spark.sparkContext._jvm
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(top).toUri().getPath():
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def crc32_mod(column: str, n: int):
    """crc32 of the id as text, modulo ``n`` (NULL ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over a ``uint64`` array."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, remembered up to ``limit`` words.

    The memory of one worker stays bounded; a forgotten word is hashed again.
    """

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Base of the rolling hash and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2^64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every run of ``k`` consecutive words, in linear time."""
    n = len(hashes)
    if n < k:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * powers(BASE, n), out=sums[1:])
    return mix64((sums[k:] - sums[:-k]) * powers(BASE_INV, n - k + 1))


def crc(data: bytes) -> int:
    return zlib.crc32(data) & 0xFFFFFFFF


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, modulo: int, held_out: int,
                    limit: int) -> DataFrame:
    """(doc_id, text, label): texts of at most ``limit`` labelled ids, chosen by a
    hash of the id, none of them with crc32(id) mod ``modulo`` equal to ``held_out``.

    ``limit`` bounds what a classifier is fitted on, and so the table that is
    broadcast here. An id that is labelled more than once counts by its largest label.
    """
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
              .where(crc32_mod("doc_id", modulo) != held_out)
              .groupBy("doc_id").agg(F.max(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


#: One memory of word hashes a worker, whatever operators its tasks belong to.
WORD_HASHES = WordHashes()


def forget_hashes() -> None:
    WORD_HASHES.clear()

#: What tasks in this worker remember between them: (operator, how to forget it).
_remembered: list[tuple] = []


def remembers(name: str, forget) -> None:
    """Called as a task starts that remembers words from task to task: workers outlive an
    operator, so what an earlier one remembers here is given up first."""
    if [n for n, _ in _remembered] != [name]:
        for _, drop in _remembered:
            drop()
        if _remembered:
            give_back()
        _remembered[:] = [(name, forget)]


def give_back() -> None:
    """Free memory goes back to the system: what many small words leave free would
    otherwise stay with the worker as long as it lives."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of glibc only
    if trim is not None:
        trim(0)
