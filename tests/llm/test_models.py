import random
import zlib

import numpy as np
import pytest

from llm_cases import ODD, llm, none, odd  # noqa: F401
from motorlake.llm import language, mixing, secrets

SOUNDS = {"xa": ["ko", "ta", "mi", "ru"], "xb": ["schle", "gro", "fft", "ung"], "xc": ["ñao", "éte", "ía", "que"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(5)
    return [(i, speak(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(rng.choice(list(SOUNDS)) for _ in range(400))]


def test_language_held_out_accuracy_and_brute_force(llm, spoken):
    rows = spoken + [(1000, None, "xa"), (1001, "", "xb"), (1002, "123 !!", "xb"), (1003, "koko", None), (None, "schleung", "xb"), (7, *spoken[7][1:])]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "'x' AS score", "'y' AS lang_pred")
    got = language.learn_and_predict(df).collect()
    assert len(got) == len(rows)
    truth = {d: lang for d, _, lang in spoken}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d, *_ in rows if d is not None and zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held if r.doc_id in truth]) > 0.97
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1000, 1001, 1002))
    assert all(0 <= r.score <= 1 for r in got)

    # The folded weights give what kernel rows and landmarks give one by one.
    texts = [t for _, t, _ in spoken[:20]]
    sets = [set(language.present(t).tolist()) for t in texts]
    model = language.Model(["only"], np.zeros((1 << language.GRAM_BITS, 1), np.float32))
    mark = sets[0]
    model.weights[list(mark), 0] = 1 / np.sqrt(len(mark))
    want = [len(s & mark) / np.sqrt(len(s) * len(mark)) for s in sets]
    assert np.allclose(model.scores(texts)[:, 0], want, atol=1e-5)


def test_language_learns_from_every_row(llm):
    """Machines and limits as from plain numpy over all rows, more of them than any sample had."""
    rng = random.Random(2)
    langs = ["xa"] * 1300 + ["xb"] * 1100 + ["xc"] * 5
    rows = [(i, speak(rng, lang, rng.randint(2, 6)), lang) for i, lang in enumerate(langs)]
    df = llm.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(7)
    model = language.fit(df)
    marks = [np.unique(language.present(r.text)) for r in language.sample(df, "lang", language.LANDMARKS_PER_LANGUAGE).orderBy("lang", "_n").collect()]
    flags = np.zeros((2, len(rows), 1 << language.GRAM_BITS), np.float32)
    for side, sets in zip(flags, (marks, [language.present(t) for _, t, _ in rows])):
        for i, s in enumerate(sets):
            side[i, s] = 1 / np.sqrt(len(s))
    marked, every = flags[0, :len(marks)], flags[1]
    values, vectors = np.linalg.eigh((marked @ marked.T).astype(float))
    half = vectors[:, values > 1e-8 * values[-1]] / np.sqrt(values[values > 1e-8 * values[-1]])
    x, names = (every @ marked.T) @ half, np.array(langs)
    for c, lang in enumerate(["xa", "xb", "xc"]):
        share = np.where(names == lang, 0.5 / (names == lang).sum(), 0.5 / (names != lang).sum())
        beta = np.linalg.solve((x * share[:, None]).T @ x + language.RIDGE * np.eye(x.shape[1]), (x * share[:, None]).T @ np.where(names == lang, 1.0, -1.0))
        assert np.allclose(model.weights[:, c], marked.T @ (half @ beta), atol=1e-4)

    margin, share = language.limits(df.where("lang <> 'xc'"), model)
    judged = {}
    for _, t, lang in rows:
        words = t.split()
        for part in [t] + [" ".join(words[len(words) // 2:][:n]) for n in (1, 2, 3, 5, 10, 20)]:
            s, sizes, known = model.judge([part])
            judged.setdefault(lang, []).append((max(0, -s.max() / 2) * np.sqrt(sizes[0]), known[0]))
    pairs = [(v, 1 / len(judged[lang])) for lang in ("xa", "xb") for v in judged[lang]]

    def quantile(k, part):
        order = sorted((v[k], w) for v, w in pairs)
        return order[np.searchsorted(np.cumsum([w for _, w in order]), part * 2)][0]

    assert abs(margin / language.SLACK - quantile(0, 0.995)) < 0.002
    assert abs(share * language.SLACK - quantile(1, 0.01)) < 0.002


def test_language_of_odd_rows(llm, odd, none):
    assert language.learn_and_predict(none).count() == 0
    unlabelled = language.learn_and_predict(odd.selectExpr("*", "cast(null AS string) AS lang")).collect()
    assert len(unlabelled) == len(ODD) and {r.lang_pred for r in unlabelled} == {"und"}
    kept = language.keep_identified(odd, language.Model(["xx"], np.zeros((1 << language.GRAM_BITS, 1), np.float32)), 0.4)
    assert kept.columns == odd.columns and sorted(kept.select("text").toPandas().text) == sorted(t for _, t in ODD if t and t.strip())


def test_signs_are_no_letters(llm):
    model = language.Model(["xx"], np.ones((1 << language.GRAM_BITS, 1), np.float32))
    rows = [(i, t) for i, t in enumerate(["²", "½ ①", "Ⅷ", "12 !?", "ª", "漢", "a²", "", None])]
    got = {r.doc_id: r.lang_pred for r in language.predict(llm.createDataFrame(rows, "doc_id bigint, text string"), model).collect()}
    assert [got[i] for i, _ in rows] == ["und"] * 4 + ["xx"] * 3 + ["und"] * 2


def test_mixing_meets_targets(llm):
    rng = random.Random(1)
    words = {"good": "alpha beta gamma".split(), "poor": "spam cheap click".split(), "toxic": "awful nasty vile".split()}
    docs, labels = [], []
    for i in range(900):
        domain = rng.choice(["good", "good", "poor", "toxic"])
        docs.append((i, " ".join(rng.choice(words[domain] + ["the", "of"]) for _ in range(rng.randint(5, 40)))))
        if i % 2:
            labels.append((i, int(domain == "good"), int(domain == "toxic")))
    labels += [(None, 1, 0), (3, None, None), (5000, 1, 0)]
    d = llm.createDataFrame(docs + [(900, None), (901, ""), (0, docs[0][1]), (None, "alpha")], "doc_id bigint, text string")
    d = d.selectExpr("*", "'x' AS rate", "'y' AS domain", "1 AS _id")
    labelled = mixing.domain_marks(llm.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    targets = {"good": 0.8, "poor": 0.2}
    rated, domains = mixing.mix(d, labelled, targets)
    rows = rated.toPandas()
    p, w, r = np.stack(rows.posterior), rows.n_tokens.to_numpy(float), rows.rate.to_numpy()
    assert (r >= 0).all() and domains == ["good", "poor", "toxic"] and len(rows) == 904
    assert np.allclose((p * (w * r)[:, None]).sum(0) / w.sum(), [0.8, 0.2, 0.0], atol=0.02)
    # Brute force: the same objective, minimised by long projected gradient in numpy.
    share, x = (p * w[:, None]).sum(0) / w.sum(), np.ones(len(w))
    for _ in range(60_000):
        e = (p * (w * x)[:, None]).sum(0) / w.sum() - np.array([0.8, 0.2, 0.0])
        x = np.maximum(0, x - 0.3 * (p @ (e / share) + mixing.PULL * (x - 1)))
    assert np.abs(x - r)[w > 0].max() < 1e-3

    again = mixing.resample(d, labelled, targets)
    assert again.columns == d.columns
    counts = again.groupBy("doc_id", "text").count().toPandas()
    assert set(counts["count"]) <= {1, 2, 3, 4} and (counts.text.fillna("") == "").sum() == 2


def test_repeated_rows_are_learned_from_once(llm):
    rows = [(i, f"word{i} one two", "xa" if i % 2 else "xb") for i in range(20)]
    once = llm.createDataFrame(rows, "doc_id bigint, text string, lang string")
    many = llm.createDataFrame(rows + [rows[3]] * 60, "doc_id bigint, text string, lang string")
    drawn = lambda df: sorted((r.text, r.lang, r["_n"]) for r in language.sample(df, "lang", 8).collect())
    assert drawn(many) == drawn(once) and len(drawn(many)) == 16
    marks = llm.createDataFrame([(i, "good" if i % 2 else "poor") for i in range(20)], "doc_id bigint, domain string")
    a, b = mixing.fit(once, marks, per_domain=6), mixing.fit(many, marks, per_domain=6)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.bias, b.bias)


def test_mixing_without_rows_or_labels(llm, odd, none):
    marks = llm.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rated, domains = mixing.mix(odd, mixing.domain_marks(marks), {"good": 1.0})
    assert domains == [] and {r.rate for r in rated.collect()} == {1.0}
    assert mixing.resample(odd, mixing.domain_marks(marks), {}).count() == len(ODD)
    assert mixing.resample(none, mixing.domain_marks(marks), {}).count() == 0


def secret_rows():
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    plain = lambda: "".join(rng.choice(["thing", "ation", "ment", "under", "over"]) for _ in range(rng.randint(4, 6)))
    rows = []
    for i in range(120):
        kind = i % 4
        text = [f"the {plain()} of", f'use token = "{hexes(40)}" now', f"with password={hexes(18)} here", f"mail {plain()}@example.org or"][kind]
        rows.append((i, f"some words {text} and more", kind in (1, 2)))
    return rows


def test_secrets_found_and_false_positives_removed(llm):
    rows = secret_rows()
    df = llm.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").selectExpr("*", "'x' AS begin", "'y' AS word", "1 AS label")
    found = secrets.scan(df).collect()
    truth = {d: s for d, _, s in rows}
    assert {r.doc_id for r in found} == set(truth)
    assert np.mean([r.secret == truth[r.doc_id] for r in found]) > 0.97
    text = {d: t for d, t, _ in rows}
    assert all(r.candidate in text[r.doc_id][r.begin:] for r in found)


def test_secrets_candidates_against_brute_force(llm):
    import re
    texts = ["a" * 16, "a" * 15, "x=" + "b1" * 9 + "== y", "\tü" + "c" * 20 + "é" + "d" * 17 + "\n\n" + "e" * 16, None, "", " " * 40 + "f" * 30]
    rows = list(enumerate(texts))
    got = sorted((r.doc_id, r.begin, r.candidate) for r in secrets.candidates(llm.createDataFrame(rows, "doc_id bigint, text string")).collect())
    want = []
    for d, t in rows:
        for w in re.finditer(r"[^ \t\n]+", t or ""):
            want += [(d, w.start(), m[1]) for m in re.finditer(r"(?:^|[^A-Za-z0-9+/_-])([A-Za-z0-9+/_-]{16,}={0,2})", w[0])]
    assert got == sorted(want)


def test_short_and_punctuated_secrets_are_candidates_and_found(llm):
    texts = {"password=hunter2secret": "hunter2secret", "pwd: Tr0ub4dor&3xyz!": "Tr0ub4dor&3xyz!", "key=ab12cd34.ef56gh78": "ab12cd34.ef56gh78",
             "the password is s3cr3tpw ok": "s3cr3tpw", 'a {"user":"bob","password":"hunter2x"} b': "hunter2x",
             "user=a&passwd=pa55word9": "pa55word9", "auth: 'x9!k2$q'": "x9!k2$q"}
    df = llm.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r.doc_id, r.candidate) for r in secrets.candidates(df).collect()}
    assert {(i, v) for i, v in enumerate(texts.values())} <= got

    key = "24be" + "0a1b" * 8 + "07ff"
    quoted = [f'token="{key}"', f'token="{key}"###', f"token='{key}'.", f"see (token=`{key}`)!", f'{{"token":"{key}"}};']
    rows = llm.createDataFrame(list(enumerate(quoted)), "doc_id bigint, text string")
    found = sorted((r.doc_id, r.candidate) for r in secrets.candidates(rows).collect())
    assert found == [(i, key) for i in range(len(quoted))]  # one finding each

    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("abcdefghjkmnpqrstuvwxyz23456789") for _ in range(n - 1)) + "7"
    rows, want = [], {}
    for i in range(200):
        rows.append((i, f"some {rng.choice(['note', 'author', 'token'])}: {rng.choice(['garden', 'window', 'Monday', 'coffee'])} and more"))
    for i in range(200, 300):
        want[i] = word(8 + i % 8)
        rows.append((i, f"some password={want[i]} and more" if i % 2 else f"some passwd: {want[i]} and more"))
    found = secrets.scan(llm.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {(r.doc_id, r.candidate) for r in found if r.secret} == set(want.items())


def test_dictionary_counts_all_texts(llm, monkeypatch):
    monkeypatch.setattr(secrets, "DICTIONARY_TRIPLES", 2)
    docs = [(i, "alpha alp") for i in range(20)] + [(100, None), (101, "with token=" + "ab12" * 8 + " zebra zebra")]
    found = llm.createDataFrame(docs, "doc_id bigint, text string")
    assert secrets.dictionary(found) == "alp|lph"


def test_secrets_of_odd_rows(odd, none):
    assert secrets.scan(none.select("doc_id", "text")).count() == 0
    assert secrets.scan(odd).count() == 0
