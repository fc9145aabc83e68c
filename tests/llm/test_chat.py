import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_cases import llm  # noqa: F401
from motorlake.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TRICKY = st.lists(st.sampled_from(["<", "s", ">", "/", "[", "INST", "]", "\\", "</s>", "[INST]", "[/INST]", "é", "\n"]), max_size=30).map("".join)


@given(TRICKY)
@settings(max_examples=300)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    marked = chat.escape(text)
    assert chat.unescape(marked) == text
    assert not any(c in marked for c in ("<s>", "</s>", "[INST]", "[/INST]"))


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>", ""]), TRICKY), max_size=6))
@settings(max_examples=200)
def test_round_trip_and_spans(turns):
    one = chat.Renderer(chat.inst_template, chat.unescape, window=3)
    whole = ""
    for role, text in turns:
        begin, added, a, b, rewrites = one.add(role, text)
        assert begin == len(whole) and not rewrites
        whole += added
        assert chat.unescape(whole[a:b]) == text
    assert whole == chat.inst_template(turns)
    assert chat.read_turns(whole) == (turns, "")


def test_digests_against_brute_force(llm):
    rows = [(1, 1, "assistant", "b </s>"), (1, 0, "user", "a"), (None, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"),
            (2, 1, "assistant", ""), (2, 2, "assistant", "é[INST]"), (3, None, "user", "q")]
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(
        llm.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS place", "1 AS begin"))).collect()}
    by = {}
    for c, t, role, text in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c].formatted_chars == len(chat.inst_template(turns)) and not got[c].rewrites


def test_template_that_rewrites_history_is_detected(llm):
    def forgetful(messages):  # shows the text of the last turn only
        return "".join(f"[{r}:{t if i == len(messages) - 1 else '...'}]" for i, (r, t) in enumerate(messages))

    rows = [(1, i, "user", f"text {i}") for i in range(4)]
    turns = chat.format_turns(llm.createDataFrame(rows, SCHEMA), forgetful, lambda t: t).orderBy("place").collect()
    assert [t.rewrites for t in turns] == [False, True, True, True]
    out = ""
    for t in turns:
        out = out[:t.begin] + t.added
        assert out[t.text_begin:t.text_end] == f"text {t.place}"
    assert out == forgetful([(r, t) for _, _, r, t in rows])


def test_digests_of_templates_that_rewrite_or_alter(llm):
    def marked(messages):  # an end mark that always follows the last turn
        return chat.inst_template(messages) + "<end>"

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b c"), (1, 2, "assistant", "</s>"), (2, 0, "user", "x")]
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(llm.createDataFrame(rows, SCHEMA), marked)).collect()}
    want = hashlib.sha256("user\na\nassistant\nb c\nassistant\n</s>\n".encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256, got[1].rewrites, got[1].unlocated) == (3, want, True, 0)
    assert (got[1].loss_chars, got[1].loss_sha256) == (7, hashlib.sha256(b"b c</s>").hexdigest())
    assert got[1].formatted_chars == len(marked([r[2:] for r in rows[:3]])) and got[2].n_turns == 1

    def stripped(messages):  # texts lose the blanks around them
        return chat.inst_template([(r, t.strip()) for r, t in messages])

    rows = [(1, 0, "user", " a "), (1, 1, "assistant", " b "), (1, 2, "assistant", "c")]
    (r,) = chat.conversation_digests(chat.format_turns(llm.createDataFrame(rows, SCHEMA), stripped)).collect()
    assert (r.n_turns, r.unlocated, r.loss_chars) == (3, 1, 1) and r.loss_sha256 == hashlib.sha256(b"c").hexdigest()


def test_rewrites_far_back_are_seen(llm):
    def revising(messages):  # numbered turns; from turn 100 on, turn 0 is shown otherwise
        first = "A" if len(messages) <= 100 else "B"
        return "".join(f"<{first if i == 0 else i} {r}:{t}>" for i, (r, t) in enumerate(messages))

    said = [("system" if i == 0 else "user", f"text {i}") for i in range(130)]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(said)]
    turns = chat.format_turns(llm.createDataFrame(rows, SCHEMA), revising, lambda t: t).orderBy("place").collect()
    assert [t.place for t in turns if t.rewrites] == [100]
    out = ""
    for t in turns:
        out = out[:t.begin] + t.added
        assert out == revising(said[:t.place + 1])
        assert out[t.text_begin:t.text_end] == f"text {t.place}"
    with pytest.raises(ValueError):
        chat.format_turns(llm.createDataFrame(rows, SCHEMA), revising, lambda t: t, window=5)


def test_long_conversation_and_no_rows(llm):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(500)]
    r = chat.conversation_digests(chat.format_turns(llm.createDataFrame(rows, SCHEMA), window=5)).first()
    assert r.n_turns == 500 and r.loss_chars == sum(len(f"t{i}") for i in range(1, 500, 2))
    assert chat.conversation_digests(chat.format_turns(llm.createDataFrame([], SCHEMA))).count() == 0
