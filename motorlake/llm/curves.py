"""Nearest neighbours over shifted Hilbert curves.

Vectors are projected, shifted and laid along several Hilbert curves; every curve is range-partitioned by Spark, and
each query takes the rows within a window of its place on every curve. The windows merge and rerank by the exact
distance. What that leaves open is closed on the first curve: its rows are kept in blocks of neighbours with centre and
radius, and a query goes on to every block that can still hold something nearer than its k-th neighbour so far (by the
triangle inequality). So the result is exact; on vectors with structure few blocks are opened, on vectors without any
(no index can be of help there) most are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import scratch_path, staged

AXES, BITS = 9, 7
BLOCK_ROWS = 256
PARTITION_ROWS = 50_000
QUERY_CHUNK = 4096

_KEYED = "curve int, key bigint, vec_id bigint, vec binary"
_FOUND = "query_id bigint, vec_id bigint, score double"


def hilbert_keys(cells: np.ndarray) -> np.ndarray:
    """Places of integer points (rows of AXES coordinates below 2**BITS) along the Hilbert curve."""
    x = cells.T.astype(np.int64).copy()
    axes = len(x)
    bit = 1 << (BITS - 1)
    while bit > 1:
        low = bit - 1
        for i in range(axes):
            set_ = (x[i] & bit) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    bit = 1 << (BITS - 1)
    while bit > 1:
        turn ^= np.where((x[-1] & bit) != 0, bit - 1, 0)
        bit >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(BITS - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def exact_distances(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, the components added in order."""
    total = np.zeros(len(rows))
    for j in range(len(query)):
        total += (query[j] - rows[:, j]) ** 2
    return np.sqrt(total)


def _top(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """Positions of the k nearest of each query, ties to the smaller id; an id counts once, at its nearest."""
    order = np.lexsort((ids, scores, query))
    q, i = query[order], ids[order]
    _, first = np.unique(np.stack([q, i]), axis=1, return_index=True)
    order = order[np.sort(first)]
    q = query[order]
    starts = np.concatenate([[0], np.flatnonzero(q[1:] != q[:-1]) + 1]) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < k]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def usable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, str, int]:
    """Rows that take part as (vec_id, vec), their dimension, component type and number."""
    v = F.col(f"`{vector}`")
    kind = "<f4" if dict(vectors.dtypes)[vector] == "array<float>" else "<f8"
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & F.col(f"`{key}`").isNotNull() & finite & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dim, many = (sizes[0]["n"], sizes[0]["count"]) if sizes else (1, 0)
    element = "float" if kind == "<f4" else "double"
    return rows.where(F.size(v) == dim).select(
        F.col(f"`{key}`").cast("bigint").alias("vec_id"), v.cast(f"array<{element}>").alias("vec")), dim, kind, many


def _moments(rows: DataFrame, dim: int) -> tuple[np.ndarray, float]:
    """Mean vector and mean deviation of a component, over all rows: two numbers per component leave each task."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, n = np.zeros(dim), np.zeros(dim), 0
        for b in batches:
            x = b.column("vec").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)
            one, two, n = one + x.sum(0), two + (x * x).sum(0), n + len(x)
        yield pa.RecordBatch.from_pydict({"j": np.arange(dim), "one": one, "two": two, "n": np.full(dim, n)})

    sums = rows.select("vec").mapInArrow(add, "j bigint, one double, two double, n bigint").groupBy("j").agg(
        F.sum("one").alias("one"), F.sum("two").alias("two"), F.sum("n").alias("n")).orderBy("j").toPandas()
    n = max(1, sums.n.max())
    mean = (sums.one / n).to_numpy()
    return mean, float(np.sqrt(max((sums.two / n - mean * mean).clip(lower=0).mean(), 1e-300)))


def _along(rows: DataFrame, curves: range, dim: int, kind: str, mean: np.ndarray, deviation: float, seed: int) -> DataFrame:
    """Each row once per curve, with its key there."""
    maps = []
    for c in curves:
        rng = np.random.default_rng([seed, c])
        axes = np.linalg.qr(rng.normal(size=(dim, max(dim, AXES))))[0][:, :AXES] if dim >= AXES else rng.normal(size=(dim, AXES))
        maps.append((c, axes, rng.random(AXES)))

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column("vec").flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)
            raw = pa.array([r.tobytes() for r in flat], pa.binary())
            for c, axes, shift in maps:
                place = ((flat - mean) @ axes / (8 * deviation) + 0.5 + (shift - 0.5) / 4) * (1 << BITS)
                keys = hilbert_keys(np.clip(place, 0, (1 << BITS) - 1).astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), c, np.int32)), pa.array(keys), b.column("vec_id"), raw],
                                                 names=["curve", "key", "vec_id", "vec"])

    return rows.mapInArrow(lay, _KEYED)


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held).combine_chunks() if held else None


def _windows(keyed: DataFrame, partitions: int, window: int, every: int, k: int, kind: str) -> DataFrame:
    """The k nearest of each query within its window on each curve. A window ends at its partition's border; the shifts
    put the borders of different curves at different places."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)  # at most about PARTITION_ROWS rows
        if t is None:
            return
        curve, ids = t["curve"].to_numpy(), t["vec_id"].to_numpy()
        x = _matrix(t["vec"].combine_chunks(), kind)
        for i in np.flatnonzero(ids % every == 0):
            near = np.arange(max(0, i - window), min(len(ids), i + window + 1))
            near = near[(curve[near] == curve[i]) & (ids[near] != ids[i])]
            scores = exact_distances(x[i], x[near])
            best = _top(np.zeros(len(near), int), ids[near], scores, k)
            yield pa.RecordBatch.from_pydict({"query_id": np.full(len(best), ids[i]), "vec_id": ids[near][best], "score": scores[best]})

    ordered = keyed.repartitionByRange(partitions, "curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
    return ordered.mapInArrow(search, _FOUND)


def _blocks(keyed: DataFrame, partitions: int, kind: str) -> DataFrame:
    """Runs of neighbours on a curve with their centre and radius: an index that holds every row."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)
        for at in range(0, t.num_rows if t is not None else 0, BLOCK_ROWS):
            part = t.slice(at, BLOCK_ROWS)
            raw = b"".join(part["vec"].to_pylist())
            x = np.frombuffer(raw, kind).reshape(part.num_rows, -1).astype(np.float64)
            centre = x.mean(0)
            yield pa.RecordBatch.from_pydict({
                "ids": [part["vec_id"].to_numpy().astype("<i8").tobytes()], "rows": [raw], "centre": [centre.tobytes()],
                "radius": [float(exact_distances(centre, x).max())]})

    ordered = keyed.repartitionByRange(partitions, "key", "vec_id").sortWithinPartitions("key", "vec_id")
    return ordered.mapInArrow(cut, "ids binary, rows binary, centre binary, radius double")


def _open_blocks(blocks: DataFrame, ids: np.ndarray, queries: np.ndarray, reach: np.ndarray, k: int, kind: str) -> DataFrame:
    """What one bounded chunk of queries finds in the blocks that its reach touches."""
    shared = blocks.sparkSession.sparkContext.broadcast((ids, queries, reach))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qid, q, limit = shared.value
        limit, norm = limit.copy(), (q * q).sum(1)
        found = (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))
        for b in batches:
            for raw_ids, rows, centre, radius in zip(*(b.column(c).to_pylist() for c in ("ids", "rows", "centre", "radius"))):
                c = np.frombuffer(centre, "<f8")
                gap = np.sqrt(np.maximum(norm - 2 * (q @ c) + c @ c, 0)) - radius
                mine = np.flatnonzero(gap <= limit + 1e-6 * (1 + np.sqrt(norm) + radius))
                if not len(mine):
                    continue
                x = np.frombuffer(rows, kind).reshape(-1, len(c)).astype(np.float64)
                near_ids = np.frombuffer(raw_ids, "<i8")
                square = norm[mine, None] - 2 * q[mine] @ x.T + (x * x).sum(1)
                room = limit[mine] ** 2 + 1e-6 * (1 + norm[mine])
                rows_, cols = np.nonzero((square <= room[:, None]) & (near_ids[None, :] != qid[mine, None]))
                scores = np.zeros(len(rows_))
                for r in np.unique(rows_):
                    at = rows_ == r
                    scores[at] = exact_distances(q[mine[r]], x[cols[at]])
                who = np.concatenate([found[0], mine[rows_]])
                what = np.concatenate([found[1], near_ids[cols]])
                score = np.concatenate([found[2], scores])
                best = _top(who, what, score, k)
                found = who[best], what[best], score[best]
                full, at = np.unique(found[0], return_counts=True)
                last = np.cumsum(at) - 1
                limit[full[at == k]] = np.minimum(limit[full[at == k]], found[2][last[at == k]])
        yield pa.RecordBatch.from_pydict({"query_id": qid[found[0]], "vec_id": found[1], "score": found[2]})

    return blocks.mapInArrow(search, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, k: int = 10, every: int = 100, curves: int = 4, window: int = 256, seed: int = 7,
            key: str = "vec_id", vector: str = "embedding", certify: bool = True) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest other rows of every row whose id is divisible by ``every``.

    Nearest first by Euclidean distance in double precision, ties to the smaller id; all candidates if fewer than k.
    Vectors that are null, empty, all zero or hold a null or non-finite component take no part, nor do rows without id
    or of another dimension than the most frequent one (of equally frequent ones the larger). Rows that share an id
    are one candidate, at the nearest of them, and never each other's neighbours. ``certify=False`` leaves out the
    last step: windows alone, for measuring their recall. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows, dim, kind, many = usable(vectors, key, vector)
    mean, deviation = _moments(rows, dim)
    parts = lambda n: max(1, -(-n // PARTITION_ROWS), min(8, n // 1000))
    keyed = _along(rows, range(curves), dim, kind, mean, deviation, seed)
    windows = staged(_windows(keyed, parts(many * curves), window, every, k, kind), "windows")
    if not certify:
        return _ranked(windows, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

    blocks = staged(_blocks(_along(rows, range(1), dim, kind, mean, deviation, seed), parts(many), kind), "blocks")
    reach = _ranked(windows, k).groupBy("query_id").agg(F.max("score").alias("reach"), F.count(F.lit(1)).alias("n"))
    reach = reach.select(F.col("query_id").alias("vec_id"), F.when(F.col("n") == k, F.col("reach")).otherwise(float("inf")).alias("reach"))
    queries = staged(rows.where(F.col("vec_id") % every == 0).join(reach, "vec_id", "left"), "queries")
    chunks = -(-queries.count() // QUERY_CHUNK)
    path = scratch_path(spark, "opened")
    for c in range(chunks):  # one pass over the blocks for each bounded chunk of the stated query set
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).toPandas()
        q = np.stack(mine.vec.to_numpy()).astype(np.float64)
        limit = mine.reach.fillna(np.inf).to_numpy(np.float64)
        _open_blocks(blocks, mine.vec_id.to_numpy(np.int64), q, limit, k, kind).write.mode("append").parquet(path)
    found = windows.unionByName(spark.read.parquet(path)) if chunks else windows
    return _ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
