"""Small objects in a folder that every task can open as files: no committer, no listing on the driver.

The tasks' functions are nested and import what they need, so that workers don't need this package.
"""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from motorlake.session import staged

#: Bytes of pages that go to or come from a worker at a time.
BATCH_BYTES = 8 << 20


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as tasks open it, or None: a store that only Spark reaches, or no library to hand rows to tasks."""
    if importlib.util.find_spec("pyarrow") is None:
        return None
    at, fs = _file_system(spark, path)
    if fs.getUri().getScheme() != "file":
        return None
    return fs.makeQualified(at).toUri().getPath().rstrip("/") + "/"


def is_folder(spark: SparkSession, path: str) -> bool:
    at, fs = _file_system(spark, path)
    return fs.isDirectory(at)


def write_objects(rows: DataFrame, path: str, folder: str) -> None:
    """One gzip file ``day=.../object=...`` for the rows ``day, object, value`` of each task that share these two.

    As the text writer lays them out: a line feed after each value, a null as an empty one. A file gets its name
    when it is complete; the name follows from call and task, so a repeated task writes over its own.
    """
    call = str(uuid.uuid4())

    def write(batches: Iterator) -> Iterator:
        import os
        import re
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{call}.c000.txt.gz"
        now, out, packer, held, n = None, None, None, "", 0

        def part(column, value):
            if not value:
                return f"{column}=__HIVE_DEFAULT_PARTITION__"
            return f"{column}=" + re.sub(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value)

        def close():
            if out is not None:
                out.write(packer.flush())
                out.close()
                os.replace(f"{held}/.{name}.{task.taskAttemptId()}", f"{held}/{name}")

        for b in batches:
            for day, key, value in zip(*(c.to_pylist() for c in b.columns)):
                if out is None or (day, key) != now:
                    close()
                    now, held, n = (day, key), f"{folder}{part('day', day)}/{part('object', key)}", n + 1
                    os.makedirs(held, exist_ok=True)
                    out, packer = open(f"{held}/.{name}.{task.taskAttemptId()}", "wb"), zlib.compressobj(wbits=31)
                out.write(packer.compress((value or b"") + b"\n"))
        close()
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    spark, size = rows.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    at, fs = _file_system(spark, path)
    fs.mkdirs(at)
    before = spark.conf.get(size, None)
    spark.conf.set(size, str(BATCH_BYTES))
    try:
        ordered = rows.select("day", "object", F.col("value").cast("binary")).sortWithinPartitions("day", "object")
        ordered.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()
    finally:
        spark.conf.unset(size) if before is None else spark.conf.set(size, before)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(at, "_SUCCESS")).close()


def _files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``path`` of every file below the folders that Spark's readers would read; two levels down, folders are dealt to all tasks."""
    def below(deep: bool):
        def run(batches: Iterator) -> Iterator:
            import os

            import pyarrow as pa

            def hidden(name):
                return name[0] == "." or (name[0] == "_" and "=" not in name) or name.endswith("._COPYING_")

            out = []
            for b in batches:
                for path in b.column(0).to_pylist():
                    if not path.endswith("/"):
                        out.append(path)
                        continue
                    folders = [path]
                    while folders:
                        at = folders.pop()
                        with os.scandir(at) as entries:
                            for e in entries:
                                if hidden(e.name):
                                    continue
                                if e.is_dir():
                                    (folders if deep else out).append(f"{at}{e.name}/")
                                elif e.stat().st_size:
                                    out.append(at + e.name)
                                if len(out) > 10_000:
                                    yield pa.RecordBatch.from_pydict({"path": out})
                                    out = []
            yield pa.RecordBatch.from_pydict({"path": pa.array(out, pa.string())})

        return run

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = spark.createDataFrame([(f,) for f in folders], "path string")
    for deep in (False, False, True):
        found = found.repartition(tasks, "path").mapInArrow(below(deep), "path string")
    return staged(found, "object-paths")


def read_objects(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """``value, path`` of every file below the folders, gzip files unpacked; None if others are packed in another way."""
    def read(batches: Iterator) -> Iterator:
        import gzip

        import pyarrow as pa

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), pa.array([f"file://{p}" for p in paths], pa.string())], names=["value", "path"])

        values, paths, held = [], [], 0
        for b in batches:
            for path in b.column(0).to_pylist():
                with open(path, "rb") as file:
                    value = file.read()
                values.append(gzip.decompress(value) if path.endswith(".gz") else value)
                paths.append(path)
                held += len(values[-1]) + len(path)
                if held > size:
                    yield batch()
                    values, paths, held = [], [], 0
        yield batch()

    size = BATCH_BYTES
    files = _files(spark, folders)
    if files.where(F.col("path").rlike(r"\.(bz2|deflate|lz4|snappy|zst)$")).limit(1).count():
        return None
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = files.repartition(tasks, "path").mapInArrow(read, "value binary, path string")
    return found.withColumn("value", F.col("value").cast("string"))
