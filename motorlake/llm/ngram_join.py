"""N-gram Jaccard join: lossless blocking, then T-occurrence search with DivideSkip inside each block.

Sets above the similarity differ in few shingles. The hash space is cut into more parts than that, so two linked sets
agree on a whole part; equal part digests join documents into blocks that lose no link and that chance hardly joins.
Leaving the same shingles out of all sets can't make two sets differ in more of them, so the digests leave out the
commonest ones: passages that many documents share don't join blocks.
Within a block every document is a query against the inverted lists of the others: its short lists merge into counts,
its long ones are probed by binary search for the candidates left, and documents that reach the required overlap link.
Equal sets are one entry with a count. A block too large for a task is cut, and all pairs of cuts are searched.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import give_back, identity, mix64, rows_chosen, small_side, sorted_runs, staged
from motorlake.llm.components import components
from motorlake.llm.shingles import set_id, shingle_set, texts, word_hashes

#: Shingles that one task holds of one cut of a block.
BLOCK_SHINGLES = 2_000_000
#: Shingles (or as many numbers) that a task gathers before it passes them on.
BATCH_SHINGLES = 500_000
#: Shingles that the digests leave out, at most (8 bytes each), and the fewest documents that make one common.
COMMON_SHINGLES = 200_000
COMMON_DOCUMENTS = 20
#: Sets that a task remembers, so as not to send the digests of a set again (about 100 bytes each).
SEEN_SETS = 200_000
#: A list of documents to be searched for may be broadcast up to this many rows (about 40 bytes each).
BROADCAST_ROWS = 500_000


# ------------------------------------------------------------------ blocking

@functools.lru_cache(16)
def size_classes(num: int, den: int, top: int) -> tuple[tuple[int, int, int], ...]:
    """(smallest size, most differing shingles, parts) per class; linked sizes lie in one class or in two neighbours."""
    out, low = [], 1
    while low <= top:
        high = low * den // num + 1
        x = high - 1
        differ = (x + x * den // num) * (den - num) // (den + num)
        out.append((low, differ, differ + 1 + differ // 10))
        low = high
    return tuple(out)


def part_digests(shingles: np.ndarray, num: int, den: int, common: np.ndarray | None = None) -> list[np.ndarray]:
    """Digests of the parts of one set without the ``common`` shingles, for its own size class and the one below."""
    n = len(shingles)
    classes = size_classes(num, den, 1 << max(10, n.bit_length()))
    own = np.searchsorted([c[0] for c in classes], n, side="right") - 1
    if common is not None and len(common):
        shingles = shingles[common[np.minimum(np.searchsorted(common, shingles), len(common) - 1)] != shingles]
    mixed = mix64(shingles + np.uint64(0x5851F42D4C957F2D))
    out = []
    for level in (own, own - 1):
        if level < 0 or not classes[level][1]:
            continue
        _, differ, parts = classes[level]
        part = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        starts = sorted_runs(part)[:-1]
        seed = np.uint64(level * 1_000_003 + 1)
        if len(starts):
            out.append(mix64(np.add.reduceat(mixed, starts) + mix64(part[starts] * np.uint64(0x9E3779B97F4A7C15) + seed)))
        if parts - len(starts) >= parts - differ:  # so many empty parts that two sets may agree on those alone
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part[starts])
            out.append(mix64(mix64(empty + seed) + np.uint64(level)))
    return out


def _per_text(docs: DataFrame, make, schema: str) -> DataFrame:
    """``make(key columns, text bytes)`` for every row, as rows of ``schema``; yields in bounded batches."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = list(zip(*(b.column(c).to_pylist() for c in b.schema.names if c != "text")))
            out, held = [], 0
            for key, text in zip(keys, texts(b.column("text"))):
                for row, size in make(key, text):
                    out.append(row)
                    held += size
                if held > 8 * BATCH_SHINGLES:
                    yield _batch(out)
                    out, held = [], 0
            if out:
                yield _batch(out)
        give_back()

    def _batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names).cast(_arrow(schema))

    return docs.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def make(key, text):
        s = shingle_set(word_hashes(text), width)
        yield (*key, len(s), set_id(s) if len(s) else None), 24

    return _per_text(docs, make, "doc_id bigint, n bigint, set_id bigint")


def _common(docs: DataFrame, width: int) -> np.ndarray:
    """The commonest shingles, as a bounded sorted array: those that a batch of texts repeats, counted over all batches.

    Which ones they are changes the blocks, never the links.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for t in texts(b.column("text")):
                held.append(shingle_set(word_hashes(t), width))
                size += len(held[-1])
                if size > BATCH_SHINGLES:
                    yield repeated(held)
                    held, size = [], 0
            if held:
                yield repeated(held)
        give_back()

    def repeated(held):
        values, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"shingle": values[n > 1].view(np.int64), "n": n[n > 1]})

    counts = docs.select("text").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= COMMON_DOCUMENTS).orderBy(F.desc("n"), "shingle").limit(COMMON_SHINGLES)
    return np.sort(top.select("shingle").toPandas().shingle.to_numpy(np.int64).view(np.uint64))


def _digests(docs: DataFrame, width: int, num: int, den: int, common: np.ndarray) -> DataFrame:
    """The part digests of every set, once for each task that meets it: texts are read where they are, not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(common)
    seen: set[int] = set()  # each task has its own

    def make(key, text):
        s = shingle_set(word_hashes(text), width)
        if not len(s) or (own := set_id(s)) in seen:
            return
        if len(seen) >= SEEN_SETS:
            seen.clear()
        seen.add(own)
        if found := part_digests(s, num, den, shared.value):
            d = np.concatenate(found).view(np.int64)
            yield (own, d), 8 * len(d)

    return _per_text(docs, make, "set_id bigint, digests array<bigint>")


def _stars(digests: DataFrame) -> DataFrame:
    """Links from every set to the smallest set with an equal digest; one pass over sorted rows, no group is held."""
    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, root = None, None
        for b in batches:
            digest, sets = b.column("digest").to_numpy(), b.column("set_id").to_numpy()
            if not len(digest):
                continue
            edges = sorted_runs(digest)
            roots = np.repeat(sets[edges[:-1]], np.diff(edges))
            if digest[0] == now:
                roots[:edges[1]] = root
            now, root = digest[-1], roots[-1]
            links = np.unique(np.stack([sets, roots], 1)[sets != roots], axis=0)
            yield pa.RecordBatch.from_pydict({"a": links[:, 0], "b": links[:, 1]})

    ordered = digests.repartition("digest").sortWithinPartitions("digest", "set_id")
    return ordered.mapInArrow(star, "a bigint, b bigint").distinct()


def _joined(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is wanted: broadcast behind a check of the size, else an ordinary join."""
    side = small_side(wanted.withColumnRenamed("doc_id", "_id"), BROADCAST_ROWS)
    return docs.join(side, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")


# ------------------------------------------------------------------ T-occurrence search

class _Block:
    """Inverted lists over some sets: for each shingle the positions of the sets that hold it, in order of size."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(every, kind="stable")
        every, self.owner = every[order], owner[order]
        self.starts = sorted_runs(every)
        self.keys = every[self.starts[:-1]] if len(every) else every

    def search(self, query: np.ndarray, low: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions from ``low`` on, of sets at most as large as the query, that link with it."""
        n = len(query)
        at = np.searchsorted(self.keys, query)
        at = at[(at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == query)]
        starts, ends = self.starts[at], self.starts[at + 1]
        need = -(-num * n // den)  # at least so many shingles are shared
        # Only positions from low on count: cut the lists' heads off.
        lengths = ends - starts
        useful = np.flatnonzero(self.owner[ends - 1] >= low) if len(ends) else at
        starts, ends, lengths = starts[useful], ends[useful], lengths[useful]
        if len(lengths) < need:
            return _NONE
        # DivideSkip: the longest lists are left for probing, as many as keep the merge selective.
        longest = np.argsort(-lengths, kind="stable")
        n_long = int(min(need - 1, need / (0.05 * np.log2(max(2, lengths.max())) + 1), np.count_nonzero(lengths > 8)))
        long_, short = longest[:n_long], longest[n_long:]
        total = int(lengths[short].sum())
        reps = np.repeat(starts[short] - np.concatenate([[0], np.cumsum(lengths[short])[:-1]]), lengths[short])
        merged = np.sort(self.owner[np.arange(total) + reps])  # the short lists, merged
        runs = sorted_runs(merged)
        found, count = merged[runs[:-1]] if total else merged, np.diff(runs)
        keep = (count >= need - n_long) & (found >= low) & (self.sizes[found] <= n) & (self.sizes[found] * den >= num * n)
        found, count = found[keep], count[keep]
        for i, l in enumerate(long_):
            if not len(found):
                return _NONE
            list_ = self.owner[starts[l]:ends[l]]
            p = np.searchsorted(list_, found)
            count = count + ((p < len(list_)) & (list_[np.minimum(p, len(list_) - 1)] == found))
            alive = count >= need - (n_long - i - 1)
            found, count = found[alive], count[alive]
        linked = den * count >= num * (n + self.sizes[found] - count)
        return found[linked], count[linked]


_NONE = np.zeros(0, np.int64), np.zeros(0, np.int64)


def _links(within: bool, ids: np.ndarray, cuts: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], num: int, den: int):
    """(set, root, linked documents) of the pairs within one cut of a block, or of those between its two cuts."""
    order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i])), np.int64)
    ids, cuts, copies, sets = ids[order], cuts[order], copies[order], [sets[i] for i in order]
    root, degree = np.arange(len(ids)), np.zeros(len(ids), np.int64)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    block = _Block(sets)
    for i in range(len(ids)):
        found, _ = block.search(sets[i], 0, num, den)
        found = found[(found < i) if within else ((found < i) & (cuts[found] != cuts[i]))]
        if len(found):
            degree[i] += copies[found].sum()
            degree[found] += copies[i]
            top = find(i)
            for j in {find(int(f)) for f in found}:
                root[j] = top
    linked = np.flatnonzero(degree)
    return ids[linked], ids[[find(int(i)) for i in linked]] if len(linked) else ids[:0], degree[linked]


def _search(held: DataFrame, num: int, den: int) -> DataFrame:
    """Links inside every (block, cut, cut) of rows ``block, x, y, cut, set_id, copies, shingles``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for r in zip(*(part.column(c).to_pylist() for c in ("block", "x", "y", "cut", "set_id", "copies", "shingles"))):
                    if r[:3] != now:
                        yield from close(now, rows)
                        now, rows = r[:3], []
                    rows.append(r[3:])
        yield from close(now, rows)
        give_back()

    def close(block, rows):
        once = {r[1]: r for r in rows}  # a repeated row brings its set twice
        if len(once) > 1:
            cuts, ids, copies, raw = zip(*once.values())
            a, b, n = _links(block[1] == block[2], np.array(ids), np.array(cuts), np.array(copies), [np.frombuffer(x, np.uint64) for x in raw], num, den)
            yield pa.RecordBatch.from_pydict({"a": a, "b": b, "n_links": n})

    ordered = held.repartition("block", "x", "y").sortWithinPartitions("block", "x", "y")
    return ordered.mapInArrow(run, "a bigint, b bigint, n_links bigint")


# ------------------------------------------------------------------ the operator

def link_documents(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row.

    Documents link when ``den * |intersection| >= num * |union|`` of their sets of ``width``-word shingles. The
    component is the smallest key reachable by links, the document's own included; ``n_links`` counts the documents it
    links with. A null or empty text, or one of white space, has an empty set and links with nothing. Repeated rows
    are documents of their own. A null key counts as larger than all others; a component of null keys only has a null
    id. Two sets whose 64-bit ids collide would count as equal. Other columns are ignored.
    """
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    narrow = staged(_sets(rows, width), "sets")
    sets = narrow.where(F.col("n") > 0).groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"))

    digests = _digests(rows, width, num, den, _common(rows, width))
    stars = _stars(digests.select("set_id", F.explode("digests").alias("digest")))
    blocks = components(stars)
    members = staged(sets.join(blocks.withColumnRenamed("node", "set_id"), "set_id"), "members")
    cut = members.groupBy("root").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("cuts"))
    placed = members.join(cut, "root").withColumn("cut", F.pmod(F.xxhash64("set_id"), F.col("cuts")).cast("int"))

    def make(key_, text_):
        doc, set_, block, copies, cut_, cuts = key_
        s = shingle_set(word_hashes(text_), width)
        if len(s) and set_id(s) == set_:
            for other in range(cuts):
                yield (block, min(cut_, other), max(cut_, other), cut_, set_, copies, s.tobytes()), 8 * len(s)

    wanted = placed.select("doc_id", "set_id", F.col("root").alias("block"), "copies", "cut", "cuts")
    held = _per_text(_joined(rows, wanted).select("doc_id", "set_id", "block", "copies", "cut", "cuts", "text"), make,
                     "block bigint, x int, y int, cut int, set_id bigint, copies bigint, shingles binary")
    links = staged(_search(held, num, den), "links")

    labels = components(links)
    degree = links.groupBy(F.col("a").alias("set_id")).agg(F.sum("n_links").alias("n_links"))
    table = sets.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").join(degree, "set_id", "left")
    table = staged(table.select("set_id", F.coalesce("root", "set_id").alias("root"), "doc_id", (
        F.col("copies") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links")), "labelled")
    least = table.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = table.join(least, "root").select("set_id", "component_id", "n_links")
    alone = F.col("n") == 0
    return narrow.join(named, "set_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one_per_component(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100,
                           key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest key (nulls last).

    Documents with an empty set are their own component. Of repeated rows (same key and text) one is kept.
    """
    own = docs.select(identity(key, text).alias("id"), F.col(f"`{key}`").cast("bigint").alias("k"), F.col(f"`{text}`").alias("t"))
    linked = staged(link_documents(own, width, num, den, "id", "t").select(F.col("doc_id").alias("id"), "component_id"), "components")
    names = staged(own.groupBy("id", "k").agg(F.count(F.lit(1)).alias("_many")), "names")
    keyed = linked.distinct().join(names, "id")
    largest = F.lit(2**63 - 1)
    least = keyed.groupBy(F.col("component_id").alias("c")).agg(F.min(F.coalesce("k", largest)).alias("least"))
    first = keyed.join(least, (F.col("component_id") == F.col("c")) & (F.coalesce("k", largest) == F.col("least"))).groupBy("c").agg(
        F.min("id").alias("id"))
    chosen = staged(first.join(names, "id").select(F.col("id").alias("_id"), "_many"), "kept")
    return rows_chosen(docs, chosen, key, text)
