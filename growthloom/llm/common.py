"""Helpers shared by the operators: scratch tables, word streams, hashing."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.session import shared_folder

#: A word is a run of characters other than these (space, tab to carriage return).
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the session's JVM ends."""
    path = f"{shared_folder(spark)}/growthloom-{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here,
    and a lost executor costs a re-read, not a re-computation."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positional(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1...: whatever they were called, names can't clash with a working column's."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def restored(df: DataFrame, like: DataFrame) -> DataFrame:
    """The columns of ``positional(like)`` in ``df`` under their own names again."""
    return df.select(*[f"c{i}" for i in range(len(like.columns))]).toDF(*like.columns)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns of ``df``, under new names; by exact name, first come first."""
    where = {new: f"c{df.columns.index(old)}" for new, old in columns.items()}
    return positional(df).select(*[F.col(c).alias(new) for new, c in where.items()])


def word_count(text):
    """Number of words of a text column (null: 0), as a Spark expression."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text, one at a time (null: empty)."""
    raw = column.cast(pa.large_binary()) if pa.types.is_large_string(column.type) else column.cast(pa.binary())
    for value in raw:
        yield value.as_py() or b""


class Vocabulary(dict):
    """word (bytes) -> running number; ``hashes[number]`` is ``code(word)``, by default a 64-bit hash.

    Lives for one task; ``trim`` empties it once it holds ``limit`` words, so
    its memory is bounded whatever the corpus holds.
    """

    def __init__(self, limit: int = 400_000, code: Callable[[bytes], int] = xxhash.xxh64_intdigest):
        super().__init__()
        self.limit = limit
        self.code = code
        self.words: list[bytes] = []
        self.hashes = np.zeros(1 << 12, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.words)
        self.words.append(word)
        if n >= len(self.hashes):
            self.hashes = np.concatenate([self.hashes, np.zeros(len(self.hashes), np.uint64)])
        self.hashes[n] = self.code(word)
        return n

    def trim(self) -> bool:
        if len(self.words) < self.limit:
            return False
        self.clear()
        self.words = []
        return True

    def numbers(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def hashed(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers(words)
        return self.hashes[numbers]


def mixed(z: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, fixed public constants)."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words; a shorter text is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    with np.errstate(over="ignore"):
        out = hashes[: n - width + 1].copy()
        for j in range(1, width):
            out *= np.uint64(0x9E3779B97F4A7C15)
            out += hashes[j : n - width + 1 + j]
        return mixed(out + np.uint64(width))
