import hashlib
import random

import numpy as np
import pytest

from llm_cases import ODD, llm, none, odd  # noqa: F401
from motorlake.llm import exact_dedup, repeats


def brute_copies(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        known = [d for d in ids if d is not None]
        keep = max(known) if known else None
        digest, marked = hashlib.sha256(t.encode()).hexdigest(), False
        for d in ids:
            kept = d == keep and not marked
            marked |= kept
            out.append((d, keep, len(ids), kept, digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("support", [0.001, 0.2])
def test_copies(llm, support):
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"text {rng.randrange(60)}") for i in range(-50, 300)] + [(299, "hot"), (None, "hot"), (7, None), (8, "")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, exact_dedup.mark_copies(df, support=support).collect()), key=repr) == brute_copies(rows)


def test_copies_of_odd_rows(odd, none):
    got = sorted(map(tuple, exact_dedup.mark_copies(odd).collect()), key=repr)
    assert got == brute_copies(ODD)
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(2, ""), ODD[2], (4, "one"), (5, "one two"), ODD[-1]], key=repr)
    assert exact_dedup.mark_copies(none).count() == 0 and exact_dedup.drop_copies(none).count() == 0


def brute_repeats(rows, size):
    raw = [(d, (t or "").encode()) for d, t in rows]
    seen = {}
    for _, t in raw:
        for i in range(len(t) - size + 1):
            seen[t[i:i + size]] = seen.get(t[i:i + size], 0) + 1
    out = []
    for d, t in raw:
        gone = np.zeros(len(t) + 1, int)
        for i in range(len(t) - size + 1):
            if seen[t[i:i + size]] > 1:
                gone[i:i + size] = 1
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        out.append((d, len(t), len(t) - len(kept), spans, kept))
    return sorted(out, key=repr)


def repeat_rows():
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("klmnö ") for _ in range(n))
    shared = noise(900)
    rows = [(100 + i, noise(rng.randrange(250)) + shared[a:a + rng.randrange(140, 400)] + noise(rng.randrange(250)))
            for i, a in enumerate(rng.randrange(0, 600) for _ in range(25))]
    rows += [(1, "a" * 700), (2, "ab" * 300), (3, None), (4, ""), (5, "x" * 199), (6, "y" * 200), (7, "y" * 200), (8, "z" * 201),
             (9, noise(500)), (9, noise(300)), (None, noise(300)), (None, rows[0][1])]
    return rows + [rows[3]]


def test_repeats(llm):
    rows = repeat_rows()
    df = llm.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' AS id", "1 AS place").repartition(4)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in repeats.remove_repeats(df, size=200).collect()), key=repr)
    assert got == brute_repeats(rows, 200)


def test_repeats_in_odd_rows(odd, none):
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.remove_repeats(odd).collect()}
    size = len(ODD[-1][1].encode())
    assert got[6] == (size, 1) and got[4] == (0, 0)  # the long text repeats itself
    assert repeats.remove_repeats(none).count() == 0


def test_every_window_has_its_trigger_whatever_the_segments(monkeypatch):
    def triggers(raw):
        return {i: (p, common) for p, a, z, common, _ in repeats.parse(raw, 200).tolist() for i in range(a, z + 1)}

    for _, t in repeat_rows():
        raw = (t or "").encode() * 5
        monkeypatch.setattr(repeats, "SEGMENT", 1 << 19)
        whole = triggers(raw)
        assert sorted(whole) == list(range(len(raw) - 199)) and all(i <= p < i + repeats.REACH for i, (p, _) in whole.items())
        monkeypatch.setattr(repeats, "SEGMENT", 333)
        assert triggers(raw) == whole


def test_frequent_digests_are_found_once(llm):
    df = llm.createDataFrame([(i, f"t{i % 7}") for i in range(50)], "doc_id bigint, text string")
    marked = exact_dedup.mark_copies(df, support=0.1)
    plan = marked._jdf.queryExecution().analyzed().toString()
    assert "collect_frequent_items" not in plan.lower() and "collectfrequentitems" not in plan.lower()
    assert marked.count() == 50 and marked.where("kept").count() == 7
