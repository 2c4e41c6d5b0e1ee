"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a side may be broadcast; the callers measure before they do.
BROADCAST_BYTES = 64 << 20
#: Bytes of text that are hashed at a time, and powers of an odd number and of its inverse.
STRETCH = 1 << 18
_ODD = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_MIX = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX[[9, 10, 11, 12, 13, 32]] = 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    A folder of our own is set only where the session has none and runs in this process
    alone, as in tests; a cluster without one is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="linefold-"))
    return sc.getCheckpointDir()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of intermediate results, wherever Spark can write one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stable(df: DataFrame) -> DataFrame:
    """Cut the lineage through a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over each Arrow batch; batches without rows are passed over."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def measured(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, which must be materialised, marked for broadcast if its rows of
    at most ``row_bytes`` bytes fit in ``limit``; else left to a shuffled join."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def crc_fold(key, n: int):
    """crc32 of a key written as text, modulo ``n`` (null key: null)."""
    return F.crc32(key.cast("string")) % F.lit(n)


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _stretch(c: np.ndarray, starts: np.ndarray) -> np.ndarray:
    while len(_POWERS[0]) < len(c):
        for k, odd in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * (_POWERS[k][-1:] * np.uint64(odd))])
    # blanks count as 0; a sum over the stretch's powers, brought back to the word's own
    return np.add.reduceat(_MIX[c] * _POWERS[0][: len(c)], starts) * _POWERS[1][starts]


def word_hashes(c: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A polynomial (uint64) in the bytes of each word of ``c``; words begin at ``begin``
    and end at ASCII white space."""
    found, at = [], 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + STRETCH)))
        end = begin[to] if to < len(begin) else len(c)
        found.append(_stretch(c[begin[at] : end], begin[at:to] - begin[at]))
        at = to
    return np.concatenate(found) if found else np.zeros(0, np.uint64)
