"""Secret scanning: broad candidates, then a random forest that removes false positives. DataFrame functions only.

Every run of 16 or more key characters in a word is a candidate, and so is, at any length and with any characters, what
is assigned in a word or follows an assignment or a credential word. The forest sees its length, the transitions between
character classes, how much of it common letter triples cover, whether it lies in a path, and the neighbouring words;
it never sees the rule that labelled a finding. It is trained from labelled findings and scores every candidate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from motorlake.llm.common import staged

#: Key characters in a row that make a candidate by themselves, away from any assignment or credential word.
SHORTEST = 16
#: Labelled findings that the forest is trained on, at most (those with the smallest hashes), half of each label.
TRAINING_FINDINGS = 20_000
#: Letter triples of the dictionary, at most.
DICTIONARY_TRIPLES = 400
TREES, DEPTH, SEED = 24, 6, 5

_CANDIDATE = r"(?:^|[^A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{16,}={0,2})"
#: Words that announce a credential.
_HINTS = r"(?i)(pass(word|wd)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential)"
#: An assignment inside a word: all that follows the first sign, and what follows the last one of a quoted or listed part.
_ASSIGNED = r"^[^=:]*[=:]+>?(.+)$"
_PART = r"[=:]>?[\"'`]?([^\"'`,;=:]+={0,2})(?=$|[\"'`,;])"
#: Words that announce a value: a name with its sign, or a credential word without a value of its own.
_SIGN = r"^[^=:]*[=:]+>?$"
_CREDENTIAL = r"^[^=:]*" + _HINTS.replace("(?i)", "") + r"[^=:]*$"
_LINK = r"(?i)^(is|was|are|as|be|to|=+>?|:=?|->)$"
_QUOTED = r"^[(\[{<]*([\"'`])([^\"'`]+)\1.*$"
#: Quotes, brackets and stops around a value.
_AROUND = r"^[\"'`(\[{<]+|[\"'`)\]}>,;.]+$"

#: The words that may hold a candidate, with their places.
_MAYBE = """
    filter(transform(_words, (w, i) -> struct(i AS i, w AS w)), v -> v.w <> '' AND (
        (length(v.w) >= {n} AND v.w rlike '[A-Za-z0-9+/_-]{{{n}}}') OR v.w rlike '[=:]'
        OR (v.i > 0 AND get(_words, v.i - 1) rlike '[=:]>?$|{hints}')
        OR (v.i > 1 AND get(_words, v.i - 2) rlike '{hints}')))""".format(n=SHORTEST, hints=_HINTS)

FEATURES = ["length", "digits", "capitals", "symbols", "transitions", "distinct", "coverage", "path", "hinted", "assigned", "quoted"]


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, begin, candidate, word, before, after``: every candidate of every whole text.

    ``begin`` is the character offset of the word that holds it; ``before`` are the two words in front. Of a word with
    several candidates each gives a row. A null or empty text gives none; repeated rows and null keys give their own.
    """
    words = F.split(F.col("_text"), r"\s", -1)
    at = F.col("_w.i")
    near = lambda i: F.coalesce(F.get("_words", at + i), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    rows = rows.where(F.col("_text").rlike(r"[A-Za-z0-9+/_-]{%d}|[=:]|%s" % (SHORTEST, _HINTS)))
    every = rows.select("doc_id", words.alias("_words")).select("doc_id", "_words", F.explode(F.expr(_MAYBE)).alias("_w"))
    begin = F.expr("aggregate(slice(_words, 1, _w.i), 0L, (s, w) -> s + length(w) + 1)")
    found = every.select("doc_id", begin.alias("begin"), F.col("_w.w").alias("word"),
                         F.concat_ws(" ", near(-2), near(-1)).alias("before"), near(1).alias("after"),
                         near(-2).alias("_second"), near(-1).alias("_first"))
    first, second = F.col("_first"), F.col("_second")
    told = first.rlike(_SIGN) | first.rlike("(?i)" + _CREDENTIAL) | (first.rlike(_LINK) & second.rlike("(?i)" + _CREDENTIAL))
    runs = F.regexp_extract_all("word", F.lit(_CANDIDATE), 1)
    values = F.concat(F.array(F.regexp_extract("word", _ASSIGNED, 1), F.when(told, F.col("word")).otherwise("")),
                      F.regexp_extract_all("word", F.lit(_PART), 1))
    # Of a quoted value what is inside the quotes, whatever stands after them.
    values = F.transform(values, lambda v: F.regexp_replace(F.regexp_replace(v, _QUOTED, "$2"), _AROUND, ""))
    values = F.filter(values, lambda v: v.rlike("[A-Za-z0-9]"))
    each = F.explode(F.concat(runs, F.array_except(values, runs)))
    return found.select("doc_id", "begin", each.alias("candidate"), "word", "before", "after")


def _share(pattern: str) -> Column:
    return F.length(F.regexp_replace("candidate", pattern, "")) / F.length("candidate")


def dictionary(docs: DataFrame, text: str = "text") -> str:
    """A pattern of the commonest letter triples of the words of all whole texts.

    Words are counted first, with a map-side step, and their triples weighed by that. At most ``DICTIONARY_TRIPLES``
    short texts come to the driver.
    """
    words = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))), r"[^a-z]+")).alias("w"))
    counted = words.where(F.length("w") >= 3).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    triples = counted.select(F.explode(F.expr("transform(sequence(1, length(w) - 2), i -> substring(w, i, 3))")).alias("t"), "n")
    common = triples.groupBy("t").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "t").limit(DICTIONARY_TRIPLES)
    return "|".join(sorted(r["t"] for r in common.select("t").collect())) or "(?!)"


def features(found: DataFrame, common: str) -> DataFrame:
    """The findings with the forest's features, all numbers."""
    classes = reduce(lambda c, p: F.regexp_replace(c, *p), [("[a-z]", "l"), ("[A-Z]", "U"), ("[0-9]", "0"), ("[^lU0]", "s")],
                     F.col("candidate"))
    around = F.concat_ws(" ", "before", "word")
    word, size = F.col("word"), F.length("candidate")
    return found.withColumn("_classes", classes).withColumns({
        "length": size.cast("double"), "digits": _share("[^0-9]"), "capitals": _share("[^A-Z]"), "symbols": _share("[A-Za-z0-9]"),
        "transitions": F.length(F.regexp_replace("_classes", r"(.)(?=\1|$)", "")) / size,
        "distinct": F.size(F.array_distinct(F.split("candidate", ""))) / size,
        "coverage": 1 - F.length(F.regexp_replace(F.lower("candidate"), common, "")) / size,
        "path": (word.rlike(r"^(https?:|\.{0,2}/)|/.*/") | word.rlike("@")).cast("double"),
        "hinted": around.rlike(_HINTS).cast("double"),
        "assigned": (word.rlike("[=:]") | F.col("before").rlike("[=:]$")).cast("double"),
        "quoted": word.rlike("[\"'`]").cast("double")}).drop("_classes")


def label_findings(found: DataFrame) -> DataFrame:
    """Labelled findings, where none are at hand: sure secrets 1, sure non-secrets 0, all others left out.

    Sure secrets have a published credential format, or hold hexadecimal or mixed characters where a credential is
    assigned; sure non-secrets are letters only in one case, lie in an address, or repeat one character.
    """
    c, around = F.col("candidate"), F.concat_ws(" ", "before", "word")
    published = c.rlike("^(AKIA|ASIA)[0-9A-Z]{16}$") | c.rlike("^gh[pousr]_[A-Za-z0-9]{36}$")
    mixed = c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    given = mixed & around.rlike(_HINTS.replace("(?i)", "(?i)(^|[^a-z])") + r"[\"']?\s*[=:]") & ~c.rlike("(?i)example|sample|dummy|xxxx")
    plain = c.rlike("^[a-z_/-]+$") | c.rlike("^[A-Z]?[a-z]+$") | c.rlike("^[A-Z_/-]+$") | F.col("word").rlike("@|^https?:") | c.rlike(r"^(.)\1+$")
    return found.withColumn("label", F.when(published | given, 1.0).when(plain, 0.0)).where(F.col("label").isNotNull())


def train(labelled: DataFrame, most: int = TRAINING_FINDINGS) -> RandomForestClassificationModel | None:
    """A forest from rows with ``FEATURES`` and ``label``; None if both labels don't occur."""
    half = [labelled.where(F.col("label") == v).orderBy(F.xxhash64("candidate", "begin", "doc_id")).limit(most // 2) for v in (0.0, 1.0)]
    chosen = staged(half[0].unionByName(half[1]).select(*FEATURES, "label"), "findings")
    if chosen.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="_features")
    return forest.fit(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(chosen.coalesce(1)))


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """``doc_id, begin, candidate, probability, secret`` of every candidate in every whole text.

    ``labelled``: findings of the shape of ``candidates`` with a ``label`` of 0 or 1; without it ``label_findings``
    marks those of ``docs``. If only one label occurs there is nothing to learn, and every candidate counts as secret
    with a null probability. A text without candidates gives no row.
    """
    found = staged(candidates(docs, key, text), "candidates")
    common = dictionary(docs, text)
    model = train(features(label_findings(found) if labelled is None else labelled, common))
    if model is None:
        return found.select("doc_id", "begin", "candidate", F.lit(None).cast("double").alias("probability"), F.lit(True).alias("secret"))
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(features(found, common)))
    probability = vector_to_array("probability")[1]
    return scored.select("doc_id", "begin", "candidate", probability.alias("probability"), (probability >= threshold).alias("secret"))
