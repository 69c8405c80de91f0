"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import sys
import time
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from corpusforge.session import scratch_path

MIX1, MIX2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
GOLDEN = 0x9E3779B97F4A7C15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and
    read it back: cuts the lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores after it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of what has been staged: it
    does so once the driver has collected the plans' objects, which can take
    long on a driver with little to do.  The first round lets go of Python's
    handles on them."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker, whichever task uses it
    (functions pickled by value get new module globals for every task)."""
    holder = sys.modules.setdefault("_corpusforge_worker", types.ModuleType("_corpusforge_worker"))
    return holder.__dict__


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser on uint64 arrays (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX1)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX2)
    return x ^ (x >> np.uint64(31))


def splitmix(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN) + np.uint64(seed))
