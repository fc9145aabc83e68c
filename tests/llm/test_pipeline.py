"""The stages one by one against plain Python, on the small tables."""

import os

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SMALL
from llm_cases import llm  # noqa: F401
from motorlake.llm import mixing, queries
from motorlake.llm.common import staged
from test_ngram_join import shingles
from test_tokens import check_packing


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = llm.read.parquet(f"{SMALL}/documents.parquet"), {}
    out["input"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = staged(stage(llm, docs, SMALL), name)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_language_stage_keeps_what_has_letters(stages):
    before, after = texts(stages["input"]), texts(stages["language_id"])
    assert {d for d, t in before.items() if sum(c.isalpha() for c in t or "") > 200} <= set(after) <= set(before)
    assert stages["language_id"].columns == stages["input"].columns


def test_language_stage_drops_unknown_languages_and_junk_and_keeps_short_texts(llm, stages):
    foreign = [
        "我们今天去北京看长城天气非常好大家都很高兴这是一个美丽的地方历史悠久文化丰富", "天气非常好",
        "Сегодня хорошая погода и мы идём гулять в парк с друзьями после работы", "Сегодня хорошая",
        "Σήμερα ο καιρός είναι πολύ καλός και θα πάμε μια βόλτα",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto",
        "Tất cả mọi người sinh ra đều được tự do và bình đẳng về nhân phẩm và quyền lợi",
        "asdkjfh qwpeoiru zxmcnvb alskdjf qpwoeiruty zmxnbv lkjh poiqwe mnbzxc kjhqwe", "x" * 200,
        "QWxhZGRpbjpvcGVuIHNlc2FtZQ== Zm9vYmFyYmF6cXV4 dGhpcyBpcyBqdW5r c29tZSByYW5kb20="]
    words = [(r.text.split(), r.lang) for r in stages["input"].where("text IS NOT NULL").orderBy("doc_id").limit(40).collect()]
    short = [" ".join(w[5:5 + 1 + i % 8]) for i, (w, _) in enumerate(words)]
    short = [t for t in short if any(c.isalpha() for c in t)]
    planted = [(10**9 + i, t, None) for i, t in enumerate(foreign)] + [(2 * 10**9 + i, t, None) for i, t in enumerate(short)]
    extra = llm.createDataFrame(planted, "doc_id bigint, text string, lang string")
    docs = stages["input"].unionByName(extra, allowMissingColumns=True)
    kept = set(texts(corpus_pipeline.identify_language(llm, docs, SMALL)))
    assert [t for d, t, _ in planted if 10**9 <= d < 2 * 10**9 and d in kept] == []
    assert [t for d, t, _ in planted if d >= 2 * 10**9 and d not in kept] == []


def test_exact_stage(stages):
    before, after = texts(stages["language_id"]), texts(stages["exact_dedup"])
    best = {}
    for d, t in before.items():
        best[t or ""] = max(d, best.get(t or "", d))
    assert set(after) == set(best.values())


def test_near_stage(stages):
    before, after = texts(stages["exact_dedup"]), texts(stages["ngram_jaccard_join"])
    sets = {d: shingles(t, 5) for d, t in before.items()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(after) == {d for d in ids if find(d) == d}


def test_mixing_stage_keeps_the_good_and_drops_the_toxic(stages):
    before = set(texts(stages["ngram_jaccard_join"]))
    after = texts(stages["mixing"])
    marks = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SMALL}/labels.parquet'").fetchall()
    good = {d for d, q, t in marks if q == 1 and t == 0} & before
    toxic = {d for d, _, t in marks if t == 1} & before
    assert good <= set(after) <= before
    assert not toxic & set(after)


def test_toxic_tokens_left_by_the_targets(llm):
    """On sf0.01, rates from plain projected steps carried on for thousands of steps leave 0.17 % toxic tokens."""
    folder = os.path.join(os.path.dirname(SMALL), "sf0.01")
    docs, labels = (llm.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rated, domains = mixing.mix(docs, mixing.domain_marks(labels), queries.TARGETS)
    rows = rated.toPandas()
    left = (np.stack(rows.posterior) * (rows.n_tokens * rows.rate).to_numpy()[:, None]).sum(0) / rows.n_tokens.sum()
    assert dict(zip(domains, left)) == pytest.approx({"good": 0.95, "poor": 0.05, "toxic": 0.0017}, abs=5e-4)


def test_packing_stage(stages):
    rows = stages["best_fit_packing"].collect()
    check_packing(rows, 1024)
    assert {r.doc_id for r in rows} == set(texts(stages["mixing"]))
    assert sum(r.piece == 0 for r in rows) == stages["mixing"].count()


def test_stage_list():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard_join", "mixing", "best_fit_packing"]
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
