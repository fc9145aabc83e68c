"""Language identification with string kernels.

The kernel of two texts is the number of character n-grams (of every length from 1 to ``LONGEST``) present in both,
over the root of the product of their own numbers: a blended-spectrum presence kernel. Nyström landmarks turn it into
``m`` features; one ridge regression per language, one versus the rest, is fitted on them, on all labelled rows by sums
of their products. Since a text's score is linear in its kernel row, landmarks and weights multiply into one weight per
n-gram and language, and a batch is scored as one product of its presence matrix with that table.

N-grams are hashed into ``2**GRAM_BITS`` places, so the table is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from motorlake.llm.common import ROW, give_back, nested, small_side, staged, unnested

LONGEST = 4
GRAM_BITS = 18
#: Landmarks per language and in all.
LANDMARKS_PER_LANGUAGE = 40
LANDMARKS = 400
RIDGE = 1e-3
SAMPLE_BROADCAST = 200_000
BUCKETS = 64
#: Matrix rows in a block of summed products; bytes of products that a task holds before it passes them on.
BLOCK = 16
HELD_BYTES = 1 << 25
#: Bins per unit that held-out rows are counted in; the slack given to what they show; limits without any.
BINS = 1024
SLACK = 1.25
MARGIN, SHARE = 0.45, 0.6
SEGMENT = 1 << 18

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_flags = np.zeros(1 << GRAM_BITS, bool)


def has_letter(text: str) -> bool:
    """Whether a character is a letter, as ``\\p{L}`` has it: no number sign such as a superscript or a fraction is one."""
    return any(map(str.isalpha, text))


def present(text: str) -> np.ndarray:
    """Places of the n-grams present in the lower-cased whole text, ascending. Long texts go segment by segment."""
    for at in range(0, max(1, len(text)), SEGMENT):
        raw = text[at:at + SEGMENT + LONGEST - 1].lower().encode("utf-32-le", "surrogatepass")
        points = np.frombuffer(raw, np.uint32)
        h = np.zeros(len(points), np.uint32)
        for n in range(min(LONGEST, len(points))):
            h = (h[:len(points) - n] + points[n:]) * _MULTIPLIERS[n]
            h ^= h >> np.uint32(15)
            _flags[((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - GRAM_BITS))] = True
    found = np.flatnonzero(_flags)
    _flags[found] = False
    return found


class Model:
    """Languages, one weight per n-gram place and language, and which places some landmark holds (none given: all)."""

    def __init__(self, languages: list[str], weights: np.ndarray, known: np.ndarray | None = None):
        self.languages, self.weights = languages, weights
        self.known = np.ones(len(weights), bool) if known is None else known

    def judge(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores (one row per text), the number of n-gram places of each text, and the share of them in a landmark."""
        rows = [present(t) for t in texts]
        sizes = np.array([len(r) for r in rows], np.int64)
        out, share = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        full = np.flatnonzero(sizes)
        if len(full) and len(self.languages):
            starts = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            places = np.concatenate([rows[i] for i in full])
            out[full] = np.add.reduceat(self.weights[places], starts, axis=0)
            out[full] /= np.sqrt(sizes[full])[:, None]
            share[full] = np.add.reduceat(self.known[places].astype(np.int64), starts) / sizes[full]
        return out, sizes, share

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row per text: its kernel with the landmarks times their weights, every text with a letter or not."""
        return self.judge(texts)[0]


def sample(labelled: DataFrame, group: str, most: int) -> DataFrame:
    """``text``, the group and ``_n`` (from 1) of at most ``most`` rows per group: those with the smallest hashes.

    Chosen on narrow rows; whole texts of the chosen ones only are fetched. Rows equal in key, text and group count once.
    """
    digest = F.xxhash64("doc_id", "text")
    drawn = labelled.select("doc_id", group, digest.alias("_h")).distinct()
    for parts in ([group, F.pmod("_h", F.lit(BUCKETS))], [group]):  # of every bucket first, so that no task ranks a whole group
        order = Window.partitionBy(*parts).orderBy("_h", "doc_id")
        drawn = drawn.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= most)
    chosen = staged(drawn, "sample")
    side = small_side(chosen.select(F.col("doc_id").alias("_id"), "_h", F.col(group).alias("_g"), "_n"), SAMPLE_BROADCAST)
    same = (F.col("doc_id") == F.col("_id")) & (digest == F.col("_h")) & (F.col(group) == F.col("_g"))
    return labelled.join(side, same).dropDuplicates(["_id", "_h", "_g"]).select("text", group, "_n")


class Landmarks:
    """The n-gram places of some texts: a row per place in any of them, a byte per text."""

    def __init__(self, marks: list[np.ndarray]):
        self.many = len(marks)
        vocabulary = np.unique(np.concatenate(marks))
        table = np.zeros((len(vocabulary) + 1, -(-self.many // 8) * 8), np.uint8)  # the last row: places in no landmark
        for j, m in enumerate(marks):
            table[np.searchsorted(vocabulary, m), j] = 1
        self.row = np.full(1 << GRAM_BITS, len(vocabulary), np.int32)
        self.row[vocabulary] = np.arange(len(vocabulary))
        self.known = self.row < len(vocabulary)
        self.lanes = table.view(np.uint64)
        self.roots = np.sqrt([len(m) for m in marks])

    def kernel(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row per set of places (none empty), one column per landmark."""
        out = np.zeros((len(sets), self.many))
        for i, s in enumerate(sets):
            for at in range(0, len(s), 255):  # so many ones fit a byte: eight landmarks are counted by one addition
                out[i] += self.lanes[self.row[s[at:at + 255]]].sum(0, dtype=np.uint64).view(np.uint8)[:self.many]
            out[i] /= np.sqrt(len(s))
        return out / self.roots

    def weights(self, of_landmarks: np.ndarray) -> np.ndarray:
        """A weight per place and language from one per landmark and language."""
        scaled = (of_landmarks / self.roots[:, None]).astype(np.float32)
        table = self.lanes.view(np.uint8)[:, :self.many]
        parts = [table[at:at + 8192].astype(np.float32) @ scaled for at in range(0, len(table), 8192)]
        return np.concatenate(parts)[self.row]


def _products(usable: DataFrame, marks: list[np.ndarray]) -> dict[str, np.ndarray]:
    """By language: the products, summed over all its rows, of their kernel rows with a one at the end.

    The last column has the sums of the kernel rows and, at its end, their number. Tasks add up products of their rows
    and pass on blocks of ``BLOCK`` matrix rows, which are added by language and block.
    """
    shared, size = usable.sparkSession.sparkContext.broadcast(marks), len(marks) + 1

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        landmarks, held = Landmarks(shared.value), {}
        for b in batches:
            for lang, texts in b.groupby("lang").text:
                for at in range(0, len(texts), 500):
                    rows = landmarks.kernel([present(t) for t in texts.iloc[at:at + 500]])
                    rows = np.column_stack([rows, np.ones(len(rows))])
                    held[lang] = held.get(lang, 0) + rows.T @ rows
                if len(held) * size * size * 8 > HELD_BYTES:
                    yield blocks(held)
                    held = {}
        if held:
            yield blocks(held)

    def blocks(held: dict[str, np.ndarray]) -> pd.DataFrame:
        return pd.DataFrame([(lang, at, m[at:at + BLOCK].tobytes()) for lang, m in held.items() for at in range(0, size, BLOCK)],
                            columns=["lang", "at", "block"])

    def total(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        block = sum(np.frombuffer(x) for x in b.block)
        return pd.DataFrame({"lang": [key[0]], "at": [key[1]], "block": [block.tobytes()]})

    kinds = "lang string, at int, block binary"
    added = usable.select("lang", "text").mapInPandas(add, kinds).groupBy("lang", "at").applyInPandas(total, kinds)
    found: dict[str, np.ndarray] = {}
    for r in added.collect():
        block = np.frombuffer(r["block"]).reshape(-1, size)
        found.setdefault(r["lang"], np.zeros((size, size)))[r["at"]:r["at"] + len(block)] = block
    return found


def fit(labelled: DataFrame, landmarks: int = LANDMARKS_PER_LANGUAGE, ridge: float = RIDGE) -> Model:
    """A model from ``doc_id, text, lang``; rows without a language or a letter teach nothing.

    The landmarks are the rows with the smallest hashes of each language; they only span the space of the machines.
    These are fitted on every row: each adds its kernel row's products to those of its language, and only the summed
    products come to the driver. Without labelled rows the model knows no language.
    """
    def places(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [present(t).astype(np.int32).tobytes() for t in b.text]
            yield pd.DataFrame({"lang": b.lang, "n": b["_n"], "places": found})

    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    taken = sample(usable.select("doc_id", "text", "lang"), "lang", landmarks)
    rows = taken.mapInPandas(places, "lang string, n int, places binary").orderBy("lang", "n").toPandas()
    languages = sorted(set(rows.lang))
    if not languages:
        return Model([], np.zeros((1 << GRAM_BITS, 0), np.float32))
    rows = rows[rows.n <= max(1, min(landmarks, LANDMARKS // len(languages)))]
    marks = [np.frombuffer(p, np.int32) for p in rows.places]
    chosen, products = Landmarks(marks), _products(usable, marks)
    values, vectors = np.linalg.eigh(chosen.kernel(marks))
    keep = values > 1e-8 * values[-1]
    half = np.zeros((len(marks) + 1, int(keep.sum()) + 1))  # from a kernel row and its one to features and their one
    half[:-1, :-1], half[-1, -1] = vectors[:, keep] / np.sqrt(values[keep]), 1
    products = {lang: half.T @ m @ half for lang, m in products.items()}
    everything = sum(products.values())
    beta = []
    for lang in languages:  # every language weighs the same, and so do its rest and itself
        own, rest = products[lang], everything - products[lang]
        own, rest = 0.5 / own[-1, -1] * own, 0.5 / max(1, rest[-1, -1]) * rest
        beta.append(np.linalg.solve((own + rest)[:-1, :-1] + ridge * np.eye(int(keep.sum())), (own - rest)[:-1, -1]))
    weights = chosen.weights(half[:-1, :-1] @ np.stack(beta, 1))
    del products, everything, rows, marks
    give_back()
    return Model(languages, weights, chosen.known)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row from its whole text alone.

    ``score`` is the winning machine's output, -1..1 moved to 0..1: above 0.5 it claims the text. A text that is null
    or has no letter is ``und`` with score 0, and so is every text if the model knows no language. Ties go to the
    first language by name. Repeated rows and null keys give a row each; other columns are ignored.
    """
    return _judged(docs, model, key, text).select("doc_id", "lang_pred", "score")


def _judged(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """``predict`` with ``grams``, the number of n-gram places of the text, and ``share``, that of them in a landmark."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            parts = []
            for at in range(0, len(texts), 500):
                some = texts.iloc[at:at + 500].tolist()
                letters = np.array([has_letter(t) for t in some])
                s, sizes, share = m.judge(some)
                known = letters & bool(m.languages)
                best = s.argmax(1) if m.languages else np.zeros(len(some), int)
                top = np.where(known, s[np.arange(len(some)), best] if m.languages else 0, -1)
                parts.append(pd.DataFrame({
                    "lang_pred": [m.languages[b] if k else "und" for b, k in zip(best, known)],
                    "score": np.clip((top + 1) / 2, 0, 1), "grams": sizes, "share": share}))
            yield pd.concat(parts)

    out = F.pandas_udf(score, "lang_pred string, score double, grams bigint, share double")(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return docs.select(F.col(f"`{key}`").alias("doc_id"), out.alias("_p")).select("doc_id", "_p.*")


def limits(labelled: DataFrame, model: Model) -> tuple[float, float]:
    """``margin, share`` for ``keep_identified``, from all labelled documents that the model was not fitted on.

    Whole texts and runs of 1 to 20 words from their middles are judged, so that short texts are met as they are.
    Their counts in bins of ``1 / BINS`` come to the driver; every language weighs the same. Without such documents
    the limits are ``MARGIN`` and ``SHARE``.
    """
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            for lang, texts in b.groupby("lang").text:
                for at in range(0, len(texts), 100):
                    some = []
                    for t in texts.iloc[at:at + 100]:
                        words = t.split()
                        some += [t] + [" ".join(words[len(words) // 2:][:n]) for n in (1, 2, 3, 5, 10, 20)]
                    some = [t for t in some if has_letter(t)]
                    if not some:
                        continue
                    s, sizes, share = m.judge(some)
                    short = np.maximum(0, (0.5 - (s.max(1) + 1) / 2) * np.sqrt(sizes))
                    for kind, bins in (("short", np.ceil(short * BINS)), ("share", np.floor(share * BINS))):
                        found, counts = np.unique(bins.astype(np.int64), return_counts=True)
                        yield pd.DataFrame({"lang": lang, "kind": kind, "bin": found, "n": counts})

    usable = labelled.where(F.col("lang").isin(model.languages) & F.col("text").rlike(r"\p{L}"))
    counted = usable.select("lang", "text").mapInPandas(judged, "lang string, kind string, bin bigint, n bigint")
    rows = counted.groupBy("lang", "kind", "bin").agg(F.sum("n").alias("n")).orderBy("kind", "bin", "lang").toPandas()
    if not len(rows):
        return MARGIN, SHARE

    def quantile(kind: str, part: float) -> float:
        some = rows[rows.kind == kind]
        weight = (some.n / some.groupby("lang").n.transform("sum")).cumsum().to_numpy()
        return some.bin.to_numpy()[np.searchsorted(weight, part * weight[-1])] / BINS

    return float(SLACK * quantile("short", 0.995)), float(quantile("share", 0.01) / SLACK)


def keep_identified(docs: DataFrame, model: Model, least: float, text: str = "text", margin: float = 0.0,
                    share: float = 0.0) -> DataFrame:
    """The rows, with all their columns, whose text is not ``und`` and in a known language by score and n-grams.

    It has to score at least ``least - margin / sqrt(n)``, where ``n`` is the number of its n-gram places (a short
    text's score is less sure), and at least ``share`` of them have to be in some landmark: n-grams in none weigh
    nothing, so a text of them alone scores 0.5.
    """
    rows = docs.select(nested(docs))
    sure = F.col("score") >= least - margin / F.sqrt(F.greatest(F.col("grams"), F.lit(1)))
    found = _judged(rows, model, ROW, f"{ROW}`.`{text}").where((F.col("lang_pred") != "und") & sure & (F.col("share") >= share))
    return unnested(found.select(F.col("doc_id").alias(ROW)), docs.columns)


def held_out(key: str = "doc_id"):
    """Documents that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn_and_predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: fitted on the rows that are not held out, applied to all.

    A row without id is not held out, but teaches nothing.
    """
    labelled = docs.where(~held_out(key) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    found = predict(docs, fit(labelled), key, text)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
