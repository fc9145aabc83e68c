"""Versioned tables of a stream under one shared folder, switched by a commit log.

A table is a set of parts (a day, a bucket of listings), and a part is a list of
folders. A batch writes new folders beside the old ones and then one log entry
that names, for every part it changed, the folders that are valid from now on.
The entry is a single file: before it appears, readers and repeats see the state
before the batch, afterwards all tables of the batch at once. The newest entry
decides, whatever a stream's checkpoint says; a batch that is already in the log
is skipped. One writer at a time; folders that no entry names any more (of older
versions or failed attempts) may be removed by age.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from motorlake.schemas import empty

#: Appended folders of a part before they become one.
MOST_FOLDERS = 16
#: Entries after which the log repeats the whole state, so that a reader needs the newest era only.
ERA = 64
#: Buckets of the listing tables. A batch that touches few listings rewrites few of them.
BUCKETS = 256
_LOG = T.StructType([
    T.StructField("seq", T.LongType()), T.StructField("table", T.StringType()), T.StructField("part", T.StringType()),
    T.StructField("folders", T.ArrayType(T.StringType())),
])
_BATCHES = "_batches"
Parts = dict[tuple[str, str], list[str]]


class LakeStore:
    """``buckets`` is how many parts a table by listing has; it stays what it was when the store was begun."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root, buckets

    def _committed(self) -> tuple[int, Parts]:
        """Number of the newest entry, and the folders of every part. A part is a day or a bucket, so this stays small."""
        try:
            log = self.spark.read.schema(T.StructType([*_LOG.fields, T.StructField("era", T.LongType())])).parquet(f"{self.root}/log")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, {}
        era = log.agg(F.max("era")).first()[0]
        newest = log.where(F.col("era") == era).groupBy("table", "part").agg(F.max_by("folders", "seq").alias("folders"), F.max("seq").alias("seq"))
        entries = newest.collect()
        return max((e["seq"] for e in entries), default=-1), {(e["table"], e["part"]): e["folders"] for e in entries}

    def begin(self, stream: str, batch: int) -> Commit | None:
        """A commit for a stream's batch; None if the log has it already."""
        seq, parts = self._committed()
        done = parts.get((_BATCHES, stream))
        if done and int(done[0]) >= batch:
            return None
        return Commit(self, seq + 1, parts, stream, batch)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        """A table as of the newest entry."""
        return Commit(self, 0, self._committed()[1], "", 0).read(table, schema)

    def folders(self, table: str) -> dict[str, list[str]]:
        """The valid folders of a table by part."""
        return {part: list(f) for (t, part), f in self._committed()[1].items() if t == table and f}


class Commit:
    """What one batch sees and writes; nothing of it is visible to others before ``close``."""

    def __init__(self, store: LakeStore, seq: int, parts: Parts, stream: str, batch: int):
        self.spark, self.root, self.buckets = store.spark, store.root, store.buckets
        self.seq, self.stream, self.batch = seq, stream, batch
        self._parts, self._changed = parts, {}

    def read(self, table: str, schema: T.StructType, parts: list | None = None) -> DataFrame:
        """Rows of a table, or of some of its parts, with what this commit wrote."""
        wanted = None if parts is None else {str(p) for p in parts}
        live = self._parts | self._changed
        paths = [f for (t, part), folders in live.items() if t == table and (wanted is None or part in wanted) for f in folders]
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths).select(*schema.names)

    def _write(self, table: str, rows: DataFrame, part: Column) -> dict[str, str]:
        path = f"{self.root}/data/{table}/{self.seq}-{uuid.uuid4().hex[:12]}"
        rows.withColumn("_part", part.cast("string")).write.partitionBy("_part").parquet(path)
        found = self.spark.read.schema("_part string").parquet(path).distinct().collect()
        return {r["_part"]: f"{path}/_part={r['_part']}" for r in found}

    def replace(self, table: str, rows: DataFrame, part: Column, touched: list) -> None:
        """The parts ``touched`` hold exactly ``rows`` from now on."""
        written = self._write(table, rows, part)
        for p in {str(p) for p in touched} | written.keys():
            self._changed[table, p] = [written[p]] if p in written else []

    def append(self, table: str, rows: DataFrame, part: Column | None = None, merge=lambda rows: rows) -> None:
        """Add rows to their parts. A part with many folders becomes one, by ``merge`` of all its rows."""
        part = F.lit("all") if part is None else part
        written = self._write(table, rows, part)
        live = self._parts | self._changed
        full = []
        for p, folder in written.items():
            self._changed[table, p] = [*live.get((table, p), []), folder]
            if len(self._changed[table, p]) > MOST_FOLDERS:
                full.append(p)
        if full:
            schema = T.StructType([f for f in rows.schema.fields])
            self.replace(table, merge(self.read(table, schema, full)), part, full)

    def close(self) -> None:
        """Switch all tables to what this commit wrote."""
        self._changed[_BATCHES, self.stream] = [str(self.batch)]
        entries = (self._parts | self._changed) if self.seq % ERA == 0 else self._changed
        log = self.spark.createDataFrame([(self.seq, t, p, f) for (t, p), f in entries.items()], _LOG)
        log.coalesce(1).withColumn("era", F.lit(self.seq // ERA).cast("bigint")).write.mode("append").partitionBy("era").parquet(f"{self.root}/log")
