import random

import pytest

from llm_cases import ODD, llm, none, odd  # noqa: F401
from motorlake.llm import line_dedup

BLANKS = " \t\n\x0b\f\r"


def brute(rows, documents, shortest=1):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))

    seen = {}
    for _, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < shortest or seen[key(x)] < documents]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def result(df, **how):
    left = line_dedup.drop_common_lines(df, **how)
    return sorted((tuple(r) for r in left.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


PARTS = ["Shared line", "  shared LINE\t", "\x0bshared line\f\r", "SHARED LÍNE", "shared líne", "a", "B", "", " ", "own 1", "own 2", "x\x00y", "　wide　", "é"]


@pytest.mark.parametrize("hot_parts", [10_000, 20, 1])
@pytest.mark.parametrize("documents, shortest", [(3, 1), (2, 3), (1, 1)])
def test_lines_against_brute_force(llm, monkeypatch, hot_parts, documents, shortest):
    monkeypatch.setattr(line_dedup, "HOT_PARTS", hot_parts)  # all keys broadcast, some, none
    rng = random.Random(documents)
    rows = [(i, "\n".join(rng.choices(PARTS, k=rng.randrange(1, 9)) + [f"only {i}"] * rng.randrange(2))) for i in range(60)]
    rows += [(i % 7, rows[3][1]) for i in range(20)] + [(None, rows[5][1]), (None, None), (None, ""), (100, "\n"), (101, "\n\n")]
    df = llm.createDataFrame(rows, "doc_id bigint, text string")
    assert result(df, documents=documents, shortest=shortest) == brute(rows, documents, shortest)


def test_lines_of_odd_rows(odd, none):
    assert result(odd, documents=2) == brute(ODD, 2)
    left = line_dedup.drop_common_lines(odd, documents=2)
    assert sorted(left.columns) == sorted([*odd.columns, "n_lines", "n_dropped"])
    assert {r["digest"] for r in left.collect()} == {"x"}
    again = line_dedup.drop_common_lines(left)  # n_lines and n_dropped are there already
    assert sorted(again.columns) == sorted(left.columns) and again.count() == len(ODD)
    assert line_dedup.drop_common_lines(none).collect() == []


def test_long_text_with_many_shared_lines(llm):
    text = "\n".join(f"line {i}" for i in range(20_000))
    df = llm.createDataFrame([(1, text), (2, text + "\nlast"), (3, "first\n" + text)], "doc_id bigint, text string")
    assert result(df, documents=3) == [(1, "", 20_000, 20_000), (2, "last", 20_001, 20_000), (3, "first", 20_001, 20_000)]
