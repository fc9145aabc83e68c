import itertools
import random
import re

import pytest

from llm_cases import ODD, llm, none, odd  # noqa: F401
from motorlake.llm import ngram_join
from motorlake.llm.components import components
from motorlake.llm.shingles import shingle_set, word_hashes


def shingles(text, width):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, num, den):
    sets = [shingles(t, width) for _, t in rows]
    root, degree = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
            degree[i] += 1
            degree[j] += 1
            root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), d if not sets[i] else least.get(find(i)), degree[i]) for i, (d, _) in enumerate(rows)), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["of", "the", "in"] * 8 + [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for base in range(25):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 9, 10, 12, 30, 80, 150]))]
        if base % 5 == 0:
            words += passage
        for _ in range(rng.choice([1, 2, 5])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 1, 2])):
                copy[rng.randrange(len(copy))] = "Changed" if rng.random() < 0.5 else f"x{rng.random()}"
            rows.append(" ".join(copy) if rng.random() < 0.9 else "\n ".join(copy).upper())
    return [(i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("width, num, den, cut", [(3, 90, 100, 4_000_000), (5, 80, 100, 4_000_000), (2, 60, 100, 300)])
def test_equals_brute_force(llm, monkeypatch, width, num, den, cut):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", cut)  # the last case cuts its blocks
    rows = corpus(width)
    df = llm.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS set_id", "'y' AS n", "1 AS root")
    got = sorted(map(tuple, ngram_join.link_documents(df, width, num, den).collect()), key=repr)
    assert got == brute(rows, width, num, den)


def test_odd_rows(odd, none):
    got = sorted(map(tuple, ngram_join.link_documents(odd, 3, 90, 100).collect()), key=repr)
    assert got == brute(ODD, 3, 90, 100)
    kept = ngram_join.keep_one_per_component(odd)
    assert kept.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(1, None), (2, ""), (3, " \t\n"), (None, None), (4, "one"), (5, "one two"), ODD[-1]], key=repr)
    assert ngram_join.link_documents(none).count() == 0 and ngram_join.keep_one_per_component(none).count() == 0


def test_long_texts_are_read_in_segments(monkeypatch):
    import motorlake.llm.shingles as s
    text = " ".join(f"Word{i}" for i in range(5000)).encode() + b" \n" + b"y" * 3000
    whole = word_hashes(text)
    monkeypatch.setattr(s, "SEGMENT", 700)
    assert (word_hashes(text) == whole).all()
    assert len(shingle_set(whole, 3)) == 4999


def test_components(llm):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(500 + i, 501 + i) for i in range(80)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {(r.node, r.root) for r in components(llm.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {(x, find(x)) for x in list(root)}


def test_words_of_regular_letters_do_not_meet(llm):
    """Complementary Thue-Morse words have equal polynomial hashes modulo 2**64, whatever base and values."""
    for power in (10, 11, 12):
        word = [bin(i).count("1") % 2 for i in range(1 << power)]
        a, b = ("".join("ab"[x ^ flip] for x in word) for flip in (0, 1))
        assert len(set(word_hashes(f"{a} {b} {a.upper()}".encode()).tolist())) == 2
    rows = [(1, f"x y {a}"), (2, f"x y {b}"), (3, "x y " + a[:-1] + "c")]
    got = ngram_join.link_documents(llm.createDataFrame(rows, "doc_id bigint, text string"), width=3, num=90, den=100)
    assert {r.doc_id: (r.component_id, r.n_links) for r in got.collect()} == {i: (i, 0) for i in (1, 2, 3)}


def test_links_of_more_documents_than_are_broadcast(llm, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ngram_join, "SEEN_SETS", 5)
    rows = corpus(7) + [(1000 + i, "one text in many copies of itself") for i in range(30)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = sorted(map(tuple, ngram_join.link_documents(df, 3, 80, 100).collect()), key=repr)
    assert got == brute(rows, 3, 80, 100)


def test_texts_are_not_shuffled_for_their_digests(llm, monkeypatch):
    read = []
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(ngram_join, "_stars", lambda digests, f=ngram_join._stars: read.append(digests) or f(digests))
    ngram_join.link_documents(llm.range(9).selectExpr("id AS doc_id", "concat('a b c d e ', id % 3) AS text")).count()
    text = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "Exchange" not in text and "Join" not in text
