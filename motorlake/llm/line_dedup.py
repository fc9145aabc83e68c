"""Line dedup: lines that many documents share go from every document.

Lines are exploded, their normalised keys hashed, and the distinct documents of each hash counted with a map-side step.
What is over the threshold is looked up for every line: keys that hold so many of all lines that only few such keys can
exist are broadcast, the others meet their lines in an ordinary join, which no single key can skew any more. Only
digests and positions are shuffled for that; a document's text moves once, to its own list of dropped positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import nested, staged, unnested

#: What a key loses at both ends, and the letters that lose their case.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A key with over 1/HOT_PARTS of all lines is broadcast: there can't be more than HOT_PARTS of them (about 40 bytes each).
HOT_PARTS = 10_000


def split_lines(text: Column) -> Column:
    """The lines of a text; a null or empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _digest(key: Column) -> Column:
    """128 bits of a cryptographic digest: no two keys are known or likely ever to share them."""
    return F.substring(F.unhex(F.sha2(key, 256)), 1, 16)


def _long_enough(shortest: int) -> Column:
    return F.char_length(F.col("_key")) >= shortest


def common_keys(docs: DataFrame, text: str = "text", documents: int = 10, shortest: int = 1) -> DataFrame:
    """``digest, documents`` of the keys in at least ``documents`` rows; a row counts once per key."""
    own = F.array_distinct(F.transform(split_lines(F.col(f"`{text}`")), line_key))
    found = docs.select(own.alias("_keys")).select(F.explode("_keys").alias("_key")).where(_long_enough(shortest)).select(_digest(F.col("_key")).alias("digest"))
    return found.groupBy("digest").agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= documents)


def drop_common_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = 10, shortest: int = 1) -> DataFrame:
    """All columns of ``docs`` with the shared lines taken out of ``text``, and ``n_lines, n_dropped`` of each row.

    A line's key is the line without white space at both ends, A-Z in lower case. Keys of at least ``shortest`` code
    points that occur in at least ``documents`` rows lose all their lines, in every row; the others stay in their order,
    joined by a line feed (nothing left: an empty text). A document is a row: repeated rows and rows with a null ``key``
    count one by one, and repeated lines of a row once. A null or empty text is one empty line. Columns named
    ``n_lines`` or ``n_dropped`` are replaced; any other name may occur.
    """
    whole = F.col(f"`{text}`")
    common = staged(common_keys(docs, text, documents, shortest), "common-lines")
    total = docs.agg(F.sum(F.size(split_lines(whole)))).first()[0] or 0
    hot = F.broadcast(common.where(F.col("documents") * HOT_PARTS > total).select(F.col("digest").alias("hot")))
    cold = common.where(F.col("documents") * HOT_PARTS <= total).select(F.col("digest").alias("cold"))

    # Rows are told apart by key and text; rows with both in common drop the same positions.
    ids = [F.xxhash64(F.col(f"`{key}`"), whole).alias("_id"), F.xxhash64(F.lit(1), whole, F.col(f"`{key}`")).alias("_id2")]
    lines = docs.select(*ids, split_lines(whole).alias("_lines")).select("_id", "_id2", F.posexplode("_lines").alias("at", "_line"))
    lines = lines.select("_id", "_id2", "at", line_key(F.col("_line")).alias("_key")).where(_long_enough(shortest))
    lines = lines.select("_id", "_id2", "at", _digest(F.col("_key")).alias("digest")).join(hot, F.col("digest") == F.col("hot"), "left")
    # Hot lines are settled already; they go on under a key of their own position, spread over all tasks.
    own = F.encode(F.concat_ws(":", F.col("_id").cast("string"), F.col("at").cast("string")), "UTF-8")
    spread = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(own)
    looked = lines.withColumn("probe", spread).join(cold, F.col("probe") == F.col("cold"), "left")
    drops = looked.where(F.col("hot").isNotNull() | F.col("cold").isNotNull()).groupBy("_id", "_id2").agg(
        F.collect_set("at").alias("_at"))

    rows = docs.select(*ids, nested(docs)).join(drops, ["_id", "_id2"], "left")
    rows = rows.select("_row", "_at", split_lines(F.col(f"_row.`{text}`")).alias("_lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce(F.col("_at"), F.array().cast("array<int>")))
    kept = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    counts = {"n_lines": F.size("_lines"), "n_dropped": F.coalesce(F.size("_at"), F.lit(0))}
    others = [F.col(f"_row.`{c}`") for c in docs.columns if c not in (*counts, text)]
    return rows.select(*others, kept.alias(text), *[n.cast("bigint").alias(c) for c, n in counts.items()])
