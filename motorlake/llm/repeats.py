"""Repeated byte strings over a prefix-free parse.

Every text is parsed at rolling-hash triggers: the position of the smallest hash in the first ``REACH`` positions of a
window is its trigger, so equal windows have the same trigger at the same place, and phrases are never longer than
``REACH``. A window of ``size`` bytes is a suffix of the phrase before its trigger (the dictionary side) followed by
the text from the trigger on (the parse side). The corpus order of windows is taken in that way: first the parse side
is sorted, one row per trigger with the digest of all its windows' bytes; equal ones repeat as a whole. A suffix of a
phrase is combined with the parse only where that leaves it open, that is near the ends of repeats, and of equal ones
only once. As only equality up to ``size`` bytes matters, digests stand for the bytes in the order.

Rows are narrow (a few numbers per trigger), equal neighbours in the sorted order are found in one streaming pass, and no
group is ever held. Texts are read again where bytes are needed; nothing but numbers is stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from motorlake.llm.common import mix64, small_side, sorted_runs, staged
from motorlake.llm.shingles import texts

REACH = 128
GRAM = 16
SEGMENT = 1 << 19
#: Numbers per text that may be broadcast in all; beyond, an ordinary join.
BROADCAST_NUMBERS = 2_000_000

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_P_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
_LOW = np.uint64((1 << 24) - 1)
_tables: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _tables or len(_tables[0]) < n:
        _tables.clear()
        for base in (_P, _P_INVERSE):
            t = np.full(max(n, 1 << 16), base, np.uint64)
            t[0] = 1
            _tables.append(np.cumprod(t))
    return _tables


class _Digests:
    """Digests of any substrings of one segment."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[:len(data)])])

    def of(self, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
        return mix64((self.sums[starts + length] - self.sums[starts]) * self.down[starts] + np.asarray(length, np.uint64))


def _smallest(keys: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of every ``reach`` neighbouring keys."""
    blocks = -(-len(keys) // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    table = padded.reshape(blocks, reach)
    left = np.minimum.accumulate(table, axis=1).ravel()
    right = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - reach + 1
    return np.minimum(right[:n], left[reach - 1:reach - 1 + n])


def parse(text, size: int) -> np.ndarray:
    """Triggers of the windows of a text, one row each: place, first and last window start, digest of what every such
    window holds from the trigger on, digest of all bytes of these windows.

    Where a long text is cut into segments, a trigger with windows on both sides of the cut has two rows.
    """
    data = np.frombuffer(text, np.uint8)
    total = len(data) - size + 1
    if total <= 0:
        return np.zeros((0, 5), np.int64)
    common, out = size - REACH + 1, []
    for a in range(0, total, SEGMENT):
        count = min(SEGMENT, total - a)
        digests = _Digests(data[a:a + count + size - 1])
        grams = digests.of(np.arange(count + REACH - 1), GRAM)
        keys = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))  # of equal ones the rightmost
        at = (_LOW - (_smallest(keys, REACH) & _LOW)).astype(np.int64)
        runs = sorted_runs(at)
        place, first, last = at[runs[:-1]], runs[:-1], runs[1:] - 1
        context = digests.of(first, last - first + size)
        out.append(np.stack([place + a, first + a, last + a, digests.of(place, common).view(np.int64), context.view(np.int64)], 1))
    return np.concatenate(out)


def _identity() -> Column:
    """A row's number by its content: repeated rows share it, and reading again gives it again."""
    return F.xxhash64("doc_id", "text")


_PARSED = "id bigint, first bigint, last bigint, common bigint, context bigint"


def _parsed(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, parts, held = [], [], 0
            for id_, t in zip(b.column("id").to_pylist(), texts(b.column("text"))):
                rows = parse(t, size)
                if len(rows):
                    ids.append(np.full(len(rows), id_))
                    parts.append(rows)
                    held += len(rows)
                if held > 100_000:
                    yield pack(ids, parts)
                    ids, parts, held = [], [], 0
            if parts:
                yield pack(ids, parts)

    def pack(ids, parts):
        r = np.concatenate(parts)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), *(pa.array(r[:, k]) for k in (1, 2, 3, 4))],
                                          names=["id", "first", "last", "common", "context"])

    return docs.select(_identity().alias("id"), "text").mapInArrow(run, _PARSED)


def _neighbours(rows: DataFrame, outer: str, inner: str) -> DataFrame:
    """Rows whose ``outer`` value another row has too.

    ``twice``: another row has the pair (outer, inner); ``lead``: the row is the first with its pair. Rows are sorted by
    both and compared with the row before and the row after; one row is held back between batches.
    """
    schema = StructType([*rows.schema.fields, StructField("twice", BooleanType()), StructField("lead", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
            held = t.slice(t.num_rows - 1).to_batches()[0]
            out, before = compare(t.slice(0, t.num_rows - 1), before, key(held))
            yield from out
        if held is not None:
            yield from compare(pa.Table.from_batches([held]), before, None)[0]

    def key(t):
        return t.column(outer)[t.num_rows - 1].as_py(), t.column(inner)[t.num_rows - 1].as_py()

    def compare(t, before, after):
        if not t.num_rows:
            return [], before
        o, i = t.column(outer).to_numpy(), t.column(inner).to_numpy()
        same, both = np.zeros(len(o), bool), np.zeros(len(o), bool)  # as the row before
        same[1:] = o[1:] == o[:-1]
        both[1:] = same[1:] & (i[1:] == i[:-1])
        if before is not None:
            same[0] = o[0] == before[0]
            both[0] = same[0] and i[0] == before[1]
        lead = ~both
        shared, twice = same.copy(), both.copy()
        shared[:-1] |= same[1:]
        twice[:-1] |= both[1:]
        if after is not None and o[-1] == after[0]:
            shared[-1] = True
            twice[-1] |= i[-1] == after[1]
        found = t.append_column("twice", pa.array(twice)).append_column("lead", pa.array(lead)).filter(pa.array(shared))
        return found.to_batches(), (o[-1], i[-1])

    ordered = rows.repartition(outer).sortWithinPartitions(outer, inner)
    return ordered.mapInArrow(run, schema)


def _by_text(rows: DataFrame, schema: str, make) -> DataFrame:
    """``make(columns of one text's rows)`` for each text, rows in order of ``first``; a text's numbers are held at once."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for b in batches:
            ids = b.column("id").to_numpy()
            edges = sorted_runs(ids)
            out = []
            for a, z in zip(edges[:-1], edges[1:]):
                if ids[a] != now and parts:
                    out.append((now, close(parts)))
                    parts = []
                now = ids[a]
                parts.append(b.slice(a, z - a))
            yield from pack(out)
        if parts:
            yield from pack([(now, close(parts))])

    def close(parts):
        t = pa.Table.from_batches(parts)
        return make({c: t.column(c).to_numpy() for c in t.column_names})

    def pack(out):
        out = [(i, c) for i, c in out if len(c[0])]
        if out:
            ids = np.concatenate([np.full(len(c[0]), i) for i, c in out])
            columns = [np.concatenate([c[k] for _, c in out]) for k in range(len(names) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), *map(pa.array, columns)], names=names)

    return rows.repartition("id").sortWithinPartitions("id", "first").mapInArrow(run, schema)


def merged(first: np.ndarray, last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs that windows starting from ``first`` to ``last`` (ascending by first) cover together."""
    if not len(first):
        return first, first
    reach = np.maximum.accumulate(last) + size
    fresh = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1]]))
    return first[fresh], reach[np.concatenate([fresh[1:], [len(first)]]) - 1]


def _windows(docs: DataFrame, opened: DataFrame, size: int) -> DataFrame:
    """Digest of every window of the opened triggers, read from the texts again."""
    per_text = opened.groupBy("id").agg(F.collect_list(F.struct("common", "first", "last", "twice")).alias("opened"))
    side = small_side(per_text.withColumnRenamed("id", "_id"), 0 if opened.count() > BROADCAST_NUMBERS else BROADCAST_NUMBERS)
    rows = docs.select(_identity().alias("id"), "text").join(side, F.col("id") == F.col("_id")).drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            triggers, held, many = b.column("opened"), [], 0
            for n, (id_, t) in enumerate(zip(b.column("id").to_pylist(), texts(b.column("text")))):
                s = triggers[n].values
                common, first, last = (s.field(k).to_numpy() for k in range(3))
                known = s.field(3).to_numpy(zero_copy_only=False)
                order = np.argsort(first, kind="stable")
                for group in np.split(order, np.flatnonzero(np.diff(first[order] // SEGMENT)) + 1):
                    low, high = first[group].min(), last[group].max() + size
                    digests = _Digests(np.frombuffer(t[low:high], np.uint8))
                    each = last[group] - first[group] + 1
                    starts = np.arange(each.sum()) + np.repeat(first[group] - np.cumsum(each) + each, each)
                    window = digests.of(starts - low, size).view(np.int64)
                    held.append((np.full(len(starts), id_), starts, np.repeat(common[group], each), window, np.repeat(known[group], each)))
                    many += len(starts)
                if many > 100_000:
                    yield pack(held)
                    held, many = [], 0
            if held:
                yield pack(held)

    def pack(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names=["id", "first", "common", "window", "known"])

    return rows.mapInArrow(run, "id bigint, first bigint, common bigint, window bigint, known boolean")


def repeated_spans(docs: DataFrame, size: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, begin, end``: the maximal byte runs covered by strings of ``size`` bytes that start anywhere else too.

    ``id`` is a hash of key and text; see ``remove_repeats`` for what counts. ``size`` is over ``REACH + GRAM``.
    """
    assert REACH + GRAM < size < 1024, "shorter strings may hold no trigger, longer ones may share a digest"
    rows = _rows(docs, key, text)
    order = staged(_neighbours(_parsed(rows, size), "common", "context"), "parse-order")
    # A trigger whose bytes no other one has in full leaves its windows open; they are compared with those of all other
    # triggers of the same parse side, of which equal ones speak once.
    open_ = order.where(~F.col("twice")).select("common").distinct()
    opened = staged(order.where("lead").join(open_, "common", "left_semi").select("id", "common", "first", "last", "twice"), "opened")
    again = _neighbours(_windows(rows, opened, size), "window", "common").where(F.col("twice") & ~F.col("known"))
    starts = again.select("id", "first", F.col("first").alias("last")).unionByName(order.where("twice").select("id", "first", "last"))
    return _by_text(starts, "id bigint, begin bigint, end bigint", lambda c: merged(c["first"], c["last"], size))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))


def remove_repeats(docs: DataFrame, size: int = 400, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes left) of every row.

    A byte goes if it lies in a string of ``size`` bytes (UTF-8) that also starts at any other place of any text, the
    same text included; strings may overlap and are judged on the input. Matches never cross texts. A null text
    counts as empty; texts under ``size`` bytes stay whole. Repeated rows repeat each other. Null keys give rows of
    their own. ``kept`` need not be valid UTF-8. Digests stand for the strings: 64 bits decide between strings that share
    the bytes after a trigger. They are polynomials modulo 2**64, so ``size`` is under 1024, from where on words of two
    letters exist that share a digest by their structure.
    """
    rows = _rows(docs, key, text)
    spans = staged(repeated_spans(docs, size, key, text), "spans")
    per_text = spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    side = small_side(per_text.withColumnRenamed("id", "_id"), 0 if spans.count() > BROADCAST_NUMBERS else BROADCAST_NUMBERS)
    joined = rows.withColumn("id", _identity()).join(side, F.col("id") == F.col("_id"), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, held = [], 0
            for doc, t, s in zip(b.column("doc_id").to_pylist(), texts(b.column("text")), b.column("spans").to_pylist()):
                s = [(x["begin"], x["end"]) for x in s or []]
                edges = [0, *(e for span in s for e in span), len(t)]
                kept = b"".join(bytes(t[x:y]) for x, y in zip(edges[::2], edges[1::2]))
                out.append((doc, len(t), len(t) - len(kept), len(s), kept))
                held += len(kept)
                if held > 8_000_000:
                    yield pack(out)
                    out, held = [], 0
            if out:
                yield pack(out)

    def pack(out):
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                          names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
