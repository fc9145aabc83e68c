"""Best-two-fit packing over the histogram of lengths.

Pieces of equal length are interchangeable, so the packing is decided on the counts per length (at most ``capacity``
numbers, whatever the input): a bin is filled greedily from the largest length left, always with the largest that fits
the gap; then its smallest document is replaced by two unpacked documents that fit the expanded gap more tightly. The
resulting pattern is repeated as often as the counts allow. The pieces then take their places by rank within length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.bpe import encoder
from motorlake.llm.common import staged

RANK_BUCKETS = 1024


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids``: every whole text's ids and the end id, cut only where over ``capacity``.

    ``ids`` are little-endian unsigned 32-bit. Of a cut document the first piece takes what is left over. A null text
    counts as empty and becomes the end id alone. Repeated rows and null keys give pieces of their own.
    """
    tail = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for batch in batches:
            for at in range(0, len(batch), 500):
                out = []
                for doc, text in zip(batch.iloc[at:at + 500, 0], batch.iloc[at:at + 500, 1]):
                    ids = enc.ids(text) + tail
                    n = len(ids) // 4
                    edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    out += [(doc, k, a, b - a, ids[4 * a:4 * b]) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
                frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids"])
                yield frame.astype({"doc_id": "Int64", "piece": "int32", "start": "int64", "length": "int64"})

    whole = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    return whole.mapInPandas(cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def _fill(left: np.ndarray, capacity: int) -> dict[int, int]:
    """One bin as {length: how many}, from the counts left per length (a copy is used up)."""
    left = left.copy()
    bin_: dict[int, int] = {}
    gap = capacity

    def take(n: int, sign: int = 1) -> None:
        nonlocal gap
        left[n] -= sign
        gap -= sign * n
        bin_[n] = bin_.get(n, 0) + sign
        if not bin_[n]:
            del bin_[n]

    while gap:
        fits = np.flatnonzero(left[:gap + 1])
        if not len(fits):
            break
        take(int(fits[-1]))
    while gap:
        small = min(bin_)
        if len(bin_) == 1 and bin_[small] == 1:
            break
        room = gap + small
        lengths = np.flatnonzero(left[:room + 1])
        if not len(lengths):
            break
        # For each first document the largest second one that still fits; the pair must fit more tightly than now.
        at = np.searchsorted(lengths, room - lengths, side="right") - 1
        at = np.where((at >= 0) & (lengths[at] == lengths) & (left[lengths] < 2), at - 1, at)
        total = np.where(at >= 0, lengths + lengths[at], 0)
        best = int(total.argmax())
        if total[best] <= small:
            break
        take(small, -1)
        take(int(lengths[best]))
        take(int(lengths[at[best]]))
    return bin_


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Bin patterns with how often each is used; together they use up the counts exactly."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    while left.any():
        bin_ = _fill(left, capacity)
        times = min(int(left[n]) // k for n, k in bin_.items())
        for n, k in bin_.items():
            left[n] -= k * times
        out.append((bin_, times))
    return out


def _slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: the first rank of each use, the first sequence, how many per sequence, the offset there."""
    uses: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    sequence = 0
    for bin_, times in plan:
        offset = 0
        for n in sorted(bin_, reverse=True):
            uses.setdefault(n, []).append((rank.get(n, 0), sequence, bin_[n], offset))
            rank[n] = rank.get(n, 0) + bin_[n] * times
            offset += n * bin_[n]
        sequence += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*rows)) for n, rows in uses.items()}


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """The pieces (any columns, with ``length`` from 1 to ``capacity``) with ``sequence_id`` and ``offset``.

    Offsets of a sequence are gapless from 0. The driver sees the counts per length only. Ranks within a length are
    taken in buckets, so a length that a third of all pieces share spreads over the tasks. Empty in, empty out.
    """
    names = pieces.columns
    held = staged(pieces.select(F.struct("*").alias("_piece"), F.col("length").cast("int").alias("_n"),
                                F.monotonically_increasing_id().alias("_row"))
                  .withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(RANK_BUCKETS)).cast("int")), "pack")
    per_bucket = held.groupBy("_n", "_bucket").agg(F.count(F.lit(1)).alias("_many"))
    counts = {r["_n"]: r["many"] for r in per_bucket.groupBy("_n").agg(F.sum("_many").alias("many")).collect()}
    slots = _slots(patterns(counts, capacity))

    before = F.sum("_many").over(Window.partitionBy("_n").orderBy("_bucket")) - F.col("_many")
    first = per_bucket.select("_n", "_bucket", before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_n", "_bucket").orderBy("_row")) - 1
    ranked = held.withColumn("_inside", inside).join(first, ["_n", "_bucket"]).withColumn(
        "_rank", F.col("_before") + F.col("_inside"))

    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in batches:
            n, r = lengths.to_numpy(), ranks.to_numpy()
            sequence, offset = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for length in np.unique(n):
                mine = n == length
                start, base, per, at = slots[int(length)]
                use = np.searchsorted(start, r[mine], side="right") - 1
                k = r[mine] - start[use]
                sequence[mine] = base[use] + k // per[use]
                offset[mine] = at[use] + (k % per[use]) * length
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = F.pandas_udf(place, "sequence_id bigint, offset bigint")
    out = ranked.withColumn("_place", placed(F.col("_n"), F.col("_rank")))
    return out.select(*[F.col(f"_piece.`{c}`") for c in names], "_place.sequence_id", "_place.offset")
