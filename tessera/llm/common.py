"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Words of the shingle and rule operators are runs of anything but these bytes.
#: ``bytes.split()`` cuts at exactly this set (space, tab, LF, VT, FF, CR).
WORD_BREAKS = "\\x20\\x09-\\x0D"
ASCII_SPACES = " \t\n\x0b\x0c\r"

_MAX_CACHED_WORDS = 400_000
_U64 = np.uint64
_ROLL = 0x9E3779B97F4A7C15  # odd: invertible modulo 2**64


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One input table, read by Spark (``sf_dir`` may be in a store only Spark can open)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder name under the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: whatever executor is lost later, nothing above this point
    runs again, and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = shared_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions_for(df_rows: int, per_partition: int, least: int = 8) -> int:
    """Partition count that keeps about ``per_partition`` rows in each."""
    return max(least, -(-df_rows // per_partition))


def text_bytes(col: Column | str) -> Column:
    """UTF-8 bytes of a text column (null stays null)."""
    return F.col(col).cast("binary") if isinstance(col, str) else col.cast("binary")


def pieces_of(batch, rows: int = 512, size: int = 8 << 20):
    """Slices of an Arrow batch of at most ``rows`` rows and about ``size`` bytes, so Python objects stay few."""
    step = max(1, min(rows, int(rows * size / max(size, batch.nbytes * rows / max(1, batch.num_rows)))))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > _MAX_CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=_U64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits (x is changed)."""
    x ^= x >> _U64(33)
    x *= _U64(0xFF51AFD7ED558CCD)
    x ^= x >> _U64(33)
    x *= _U64(0xC4CEB9FE1A85EC53)
    x ^= x >> _U64(33)
    return x


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, in order; empty when there are fewer than ``k``."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, dtype=_U64)
    out = words[:n].copy()
    with np.errstate(over="ignore"):
        for j in range(1, k):
            out *= _U64(_ROLL)
            out += words[j : n + j]
        out += _U64(k)
        return mixed(out)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles; a shorter text is one shingle, no words none."""
    if len(words) == 0:
        return np.empty(0, dtype=_U64)
    return np.unique(gram_hashes(words, min(k, len(words))))
