"""Byte-level BPE on the workers: whole-text ids and exact prefix counts.

Texts are cut at single spaces into units ("word", " word.\\nNext", ...). A cut there never changes the library's own
splitting, unless two spaces meet; such texts, special strings and characters outside the stable ranges take the
library's own path. What a unit becomes is kept in a bounded table per worker.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
from itertools import filterfalse, islice, repeat

#: Characters on which every version of the Unicode tables agrees about letter, digit and white space.
_UNSAFE = re.compile("[^\t\n\r\x20-\x7e\xa1-˿Ͱ-ͳΆΈ-ΊΑ-Ρα-ωА-я]")
#: Fixed value: the split pattern of the byte-level vocabulary, with number signs outside \d named one by one.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_²³¹¼-¾]+| ?[\d²³¹¼-¾]+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
#: Fixed value: Unicode white space (Python's own \\s also takes U+001C to U+001F).
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2,}")
_CONTRACTION = re.compile(r"'(?:re|ve|ll)$")
TABLE_ENTRIES = 300_000


class _Table(dict):
    """What was computed once, up to a bound; what finds no room is kept until the next batch."""

    def __init__(self):
        super().__init__()
        self.wanted: dict = {}
        self.fresh: dict = {}

    def __missing__(self, key):
        return self.fresh[key]

    def learn(self, keys) -> None:
        self.wanted.update(zip(keys, repeat(None)))

    def settle(self, values) -> None:
        wanted, self.wanted = self.wanted, {}
        keys = sorted(wanted)
        self.fresh = dict(zip(keys, values(keys)))
        for k in islice(wanted, max(0, TABLE_ENTRIES - len(self))):  # what came first is the likeliest to come again
            self[k] = self.fresh.pop(k)


class _Pairs(dict):
    def __init__(self, test):
        super().__init__()
        self.test = test

    def __missing__(self, pair):
        value = self.test(pair)
        if len(self) < TABLE_ENTRIES:
            self[pair] = value
        return value


def _byte_symbols() -> dict[str, int]:
    """The printable stand-ins of a byte-level vocabulary: visible Latin-1 stays, the others follow from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids and prefix counts for one vocabulary file of byte-level BPE (``tokenizers`` format)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.load(open(path, encoding="utf-8"))
        self.special = [t["content"] for t in spec["added_tokens"]]
        self._cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        symbols = _byte_symbols()
        self.rank = {bytes(symbols[c] for c in s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self._core = tiktoken.Encoding(
            "own", pat_str=r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",
            mergeable_ranks=self.rank, special_tokens={})
        self._piece = self._core._core_bpe.encode_single_piece
        self._encode = self._core._core_bpe.encode_ordinary
        self._token = {i: b for b, i in self.rank.items()}
        #: Every beginning of a token: its id where it is one itself, else -1.
        self._begins = {b[:k]: -1 for b in self.rank for k in range(1, len(b))} | self.rank
        self._follows = _Pairs(self._compatible)
        self._units, self._piece_total = _Table(), _Table()

    def plain(self, text: str) -> bool:
        return not (_UNSAFE.search(text) or any(s in text for s in self.special))

    def ids(self, text: str) -> bytes:
        """The text's ids, little-endian unsigned 32-bit."""
        if not text:
            return b""
        if not self.plain(text):
            return array.array("I", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        return array.array("I", self._encode(text)).tobytes()

    # ------------------------------------------------------------------ prefix counts

    def _compatible(self, pair: int) -> bool:
        """Whether encoding two tokens' bytes together gives these two tokens."""
        left, right = pair >> 20, pair & 0xFFFFF
        return self._piece(self._token[left] + self._token[right]) == [left, right]

    def piece_counts(self, piece: str) -> list[int]:
        """Token count of every prefix (in characters, from 1) of one piece."""
        raw = piece.encode()
        count = next(self._walk([raw]))
        if len(raw) == len(piece):
            return count[1:]
        return [count[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]

    def _walk(self, pieces: list[bytes]):
        """For each piece in turn, the token counts of its byte prefixes (from 0), by dynamic programming.

        The encoding of a prefix ends in the one token that is compatible with the last token of what is left before
        it; so last tokens and counts follow from left to right, and no prefix is encoded anew. What a piece shares
        with the one before it stays as it is.
        """
        begins, follows = self._begins.get, self._follows
        last, count, alive, before = [0], [0], [()], b""
        for raw in pieces:
            n, same = len(raw), 0
            for x, y in zip(raw, before):
                if x != y:
                    break
                same += 1
            del last[same + 1:], count[same + 1:], alive[same + 1:]
            starts = alive[same]
            for end in range(same + 1, n + 1):
                still, found = [], False
                for start in (*starts, end - 1):
                    token = begins(raw[start:end])
                    if token is None:
                        continue
                    still.append(start)
                    if not found and token >= 0 and (not start or follows[last[start] << 20 | token]):
                        found = True
                        last.append(token)
                        count.append(count[start] + 1)
                alive.append(starts := still)
            before = raw
            yield count

    def _pieces(self, text: str) -> list[tuple[int, int]]:
        """The library's own pieces of a text without special strings, as character spans."""
        if self.plain(text):
            return [m.span() for m in _SPLIT.finditer(text)]
        return [span for _, span in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _segments(self, text: str) -> list[str]:
        """Ordinary segments and special strings in turn."""
        return self._cut.split(text) if any(x in text for x in self.special) else [text]

    def counts(self, texts: list[str]) -> list[int]:
        """The last entry of each text's prefix table: its tokens."""
        for text in texts:
            for part in self._segments(text)[::2]:
                if self._by_units(part):
                    self._units.learn(filterfalse(self._units.__contains__, part.split(" ")))
        self._units.settle(self._unit_totals)
        return [self._total(t) for t in texts]

    def _by_units(self, text: str) -> bool:
        return "  " not in text and not _UNSAFE.search(text)

    def _unit_totals(self, units: list[str]) -> list[int]:
        split = [_SPLIT.findall(" " + u) for u in units]
        for pieces in split:
            self._piece_total.learn(filterfalse(self._piece_total.__contains__, pieces))
        self._piece_total.settle(self._piece_totals)
        return [sum(map(self._piece_total.__getitem__, pieces)) for pieces in split]

    def _piece_totals(self, pieces: list[str]) -> list[int]:
        return [c[-1] for c in self._walk([p.encode() for p in pieces])]

    def _total(self, text: str) -> int:
        total = 0
        for i, part in enumerate(self._segments(text)):
            if i % 2:
                total += 1
            elif self._by_units(part):
                head, *rest = part.split(" ")
                total += sum(self.piece_counts(p)[-1] for p in _SPLIT.findall(head)) + sum(map(self._units.__getitem__, rest))
            else:
                total += sum(self.piece_counts(part[a:b])[-1] for a, b in self._pieces(part))
        return total

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def prefix_counts(self, text: str) -> list[int]:
        """Entry i: the exact token count of ``text[:i]``, for i from 0 to the text's length."""
        out = [0]
        base = 0
        parts = self._segments(text)
        for i in range(0, len(parts), 2):
            special = parts[i + 1] if i + 1 < len(parts) else ""
            table = self._ordinary(parts[i] + special[:-1])
            out += [base + c for c in table]
            if special:
                base += (table[len(parts[i]) - 1] if parts[i] else 0) + 1
                out.append(base)
        return out

    def _ordinary(self, text: str) -> list[int]:
        """Prefix counts from 1 on, for a text without whole special strings."""
        out: list[int] = []
        base = 0
        for a, b in self._pieces(text):
            piece = text[a:b]
            counts = self.piece_counts(piece)
            if _CONTRACTION.fullmatch(piece):
                counts = [counts[0], counts[0] + self.piece_counts(piece[1])[0], counts[2]]
            out += [base + c for c in counts]
            base += counts[-1]
        # A prefix that ends inside white space ends in one piece: the run so far.
        for m in _BLANKS.finditer(text):
            before = out[m.start() - 1] if m.start() else 0
            run = self.piece_counts(m.group())
            for k in range(*m.span()):
                out[k] = before + run[k - m.start()]
        return out


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)
