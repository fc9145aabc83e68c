"""Chat formatting by incremental black-box rendering.

A template is any function from a list of messages to text. Successive turn prefixes are rendered; comparing each
output with the one before locates what the turn added, and comparing it with the same turn left empty locates the
turn's text inside. An output that does not begin with the one before has rewritten history.

The whole prefix is rendered for every turn, so that any template is shown its conversation from the first turn; time
grows with the square of a conversation's length. For a template that renders every turn for itself alone (declared by
``context_free``) the context slides over the last ``WINDOW`` turns, with the same result in time in proportion to the
turns. A task streams its conversations in order and holds one conversation, or one window.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Message = tuple[str, str]
Template = Callable[[list[Message]], str]

#: Turns that a context-free template is shown at most.
WINDOW = 64


def context_free(template: Template) -> Template:
    """Declares that the template's output is the outputs of its turns, one after the other, each by itself."""
    template.context_free = True
    return template


#: The template's control strings are <s> </s> [INST] [/INST].
_ESCAPED = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    r"""No control string is left in the result: ``</s>`` becomes ``<\/s>``, a backslash is doubled."""
    return _ESCAPED.sub(lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


@context_free
def inst_template(messages: list[Message]) -> str:
    return "".join(f"<s>[INST]{escape(role)}[/INST]{escape(text)}</s>" for role, text in messages)


def read_turns(buffer: str) -> tuple[list[Message], str]:
    """The whole turns at the start of rendered text, unescaped, and the rest."""
    turns, end = [], 0
    while m := _TURN.match(buffer, end):
        turns.append((unescape(m[1]), unescape(m[2])))
        end = m.end()
    return turns, buffer[end:]


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Renderer:
    """One conversation, turn by turn. ``window`` is the most turns rendered at once; None: all of them."""

    def __init__(self, template: Template, restore: Callable[[str], str], window: int | None):
        self.template, self.restore = template, restore
        self.context: deque[Message] = deque(maxlen=None if window is None else max(1, window - 1))
        self.shown, self.length = "", 0  # what a template shows without any turn comes with the first one

    def add(self, role: str, text: str) -> tuple[int, str, int | None, int | None, bool]:
        """Where the output changes, the new output from there on, the text's span in the whole, history rewritten."""
        context = list(self.context)
        before = self.shown
        after = self.template([*context, (role, text)])
        kept = common_prefix(before, after)
        begin = self.length - (len(before) - kept)
        at = self._locate(after, self.template([*context, (role, "")]), text)
        span = (None, None) if at is None else (begin - kept + at[0], begin - kept + at[1])
        slides = self.context.maxlen is not None and len(self.context) == self.context.maxlen
        self.context.append((role, text))
        self.shown = self.template(list(self.context)) if slides else after
        self.length = begin + len(after) - kept
        return begin, after[kept:], *span, kept < len(before)

    def _locate(self, full: str, empty: str, text: str) -> tuple[int, int] | None:
        n = len(full) - len(empty)
        top = min(common_prefix(empty, full), len(empty))
        for start in range(top, max(-1, top - n - 1), -1):
            if full[start + n:] == empty[start:] and self.restore(full[start:start + n]) == text:
                return start, start + n
        return None


_TURNS = ("conv_id bigint, turn bigint, place bigint, role string, begin bigint, added string, text_begin bigint, "
          "text_end bigint, learned boolean, rewrites boolean")


def format_turns(conversations: DataFrame, template: Template = inst_template, restore: Callable[[str], str] = unescape,
                 learned_role: str = "assistant", window: int | None = None) -> DataFrame:
    """Every turn's share of its conversation's rendering, in order within a partition.

    ``conv_id, turn, place`` (from 0), ``role, begin`` (where the output changes), ``added`` (the output from there
    on), ``text_begin, text_end`` (span of the turn's text in the whole output; null if it can't be found),
    ``learned`` (text under the loss mask), ``rewrites``. Rows go by turn, then role, then text; nulls first. A null
    role or text counts as empty; a null ``conv_id`` is a conversation of its own. Repeated rows are turns of their
    own. No rows give no rows. Other columns are ignored.

    A template is rendered over the whole prefix, unless it is declared ``context_free``; then over the last ``window``
    turns (``WINDOW`` if not given). A window for any other template is refused.
    """
    free = getattr(template, "context_free", False)
    if window is not None and not free:
        raise ValueError("only a template declared context_free can be rendered in a window")
    shown = (window or WINDOW) if free else None

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, place, one = object(), 0, None
        for batch in batches:
            out = []
            for conv, turn, role, text in zip(batch.conv_id, batch.turn, batch.role, batch.text):
                if one is None or conv != now:
                    now, place, one = conv, 0, Renderer(template, restore, shown)
                out.append((None if conv == _NO_ID else conv, turn, place, role, *one.add(role, text)))
                place += 1
            frame = pd.DataFrame(out, columns=["conv_id", "turn", "place", "role", "begin", "added", "text_begin",
                                               "text_end", "rewrites"])
            frame["learned"] = frame["role"] == learned_role
            yield frame.astype({c: "Int64" for c in ("conv_id", "turn", "begin", "text_begin", "text_end")})

    _NO_ID = "none"
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(_NO_ID)).alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    typed = lambda frames: ((f.assign(turn=f.turn.astype("Int64")) for f in frames))
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.mapInPandas(lambda frames: render(typed(frames)), _TURNS)


_DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
            "formatted_chars bigint, rewrites boolean, unlocated bigint")


def conversation_digests(turns: DataFrame, context_free: bool = False) -> DataFrame:
    """One row per conversation, read back from the rendered output of ``format_turns``, in one pass without a shuffle.

    The turns are parsed from the output itself, the loss text from the located spans; both are unescaped. A turn that
    rewrites history takes back the output from its ``begin`` on, and the turns are read again from what stands then;
    for that a conversation's output is held, unless the template is ``context_free``. ``unlocated`` counts the learned
    turns whose text can't be found in the output; they add nothing to the loss text.
    """
    def close(now, s):
        return (now, s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["length"], s["rewrites"], s["unlocated"])

    def read(s, text):
        found, s["rest"] = read_turns(text)
        for role, said in found:
            s["all"].update(f"{role}\n{said}\n".encode())
        s["turns"] += len(found)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, s = None, None
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                if s is None or r.place == 0:
                    if s is not None:
                        out.append(close(now, s))
                    now = None if pd.isna(r.conv_id) else int(r.conv_id)
                    s = {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "length": 0,
                         "rewrites": False, "unlocated": 0, "rest": "", "held": []}
                if r.rewrites:
                    whole = "".join(s["held"])[:int(r.begin)] + r.added
                    s["held"], s["turns"], s["all"] = [whole], 0, hashlib.sha256()
                    read(s, whole)
                else:
                    if not context_free:
                        s["held"].append(r.added)
                    read(s, s["rest"] + r.added)
                s["length"] = int(r.begin) + len(r.added)
                s["rewrites"] |= bool(r.rewrites)
                if r.learned and pd.isna(r.text_begin):
                    s["unlocated"] += 1
                elif r.learned:
                    text = unescape(r.added[int(r.text_begin - r.begin):int(r.text_end - r.begin)])
                    s["chars"] += len(text)
                    s["loss"].update(text.encode())
            yield _frame(out)
        if s is not None:
            yield _frame([close(now, s)])

    def _frame(rows):
        names = [c.split()[0] for c in _DIGESTS.split(", ")]
        return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    return turns.mapInPandas(digest, _DIGESTS)
