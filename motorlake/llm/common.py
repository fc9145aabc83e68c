"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.session import scratch_path, shared_root, staged  # noqa: F401

ROW = "_row"


def nested(df: DataFrame) -> Column:
    """All columns of a row in one struct, so that added columns never clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW)


def unnested(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(f"{ROW}.`{c}`") for c in names])


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sorted_runs(keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values, and the total length at the end."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]]).astype(np.int64)


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """A join side with a broadcast hint if it has at most ``rows`` rows, as counted; else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


#: Rows of a list of documents that may be broadcast (some tens of bytes each).
CHOSEN_ROWS = 500_000


def identity(key: str, text: str) -> Column:
    """A row's number by its key and text: repeated rows share it, and reading the table again gives it again."""
    return F.xxhash64(F.col(f"`{key}`"), F.col(f"`{text}`"))


def rows_chosen(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` (all columns, any names) whose ``identity`` is ``chosen`` (``_id``, ``_many``), each once.

    ``_many`` says how many rows share the identity. Only rows that are repeated are shuffled to become one.
    """
    side = small_side(chosen, CHOSEN_ROWS)
    found = docs.select(identity(key, text).alias("_own"), nested(docs)).join(side, F.col("_own") == F.col("_id"))
    once = found.where(F.col("_many") == 1).unionByName(found.where(F.col("_many") > 1).dropDuplicates(["_own"]))
    return unnested(once, docs.columns)


#: Bytes of an Arrow batch where several Python stages follow each other on the same workers.
BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Whole texts reach the Python workers a few megabytes at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def give_back() -> None:
    """Hand freed memory back to the system: a worker is used again by tasks that need little of it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """In a local session, hand the package's source to the workers once, so that tasks find it from any folder.

    On a cluster the package comes with the job (``--py-files`` or ``PYTHONPATH``), and nothing is done.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or not (context.master == "local" or context.master.startswith("local[")):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="motorlake-")) / "motorlake_source.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
