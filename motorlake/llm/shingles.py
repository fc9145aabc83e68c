"""Word shingles of whole texts as 64-bit hashes, batch-wise in numpy.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. A word's hash is the sum of a random value for each
byte at its place in the word (tabulation hashing: no two words are related by their structure); long texts are read in
segments cut at white space, so memory follows the segment and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from motorlake.llm.common import mix64

SEGMENT = 1 << 19

_STEP = np.uint64(0xD6E8FEB86659FD93)
#: One random value per place in a word and byte value; later places are computed. A-Z count as a-z.
_PLACES = 64


def _values(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return mix64(mix64(place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) + byte.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


_LOWER = np.arange(256)
_LOWER[65:91] += 32
_TABLE = _values(np.repeat(np.arange(_PLACES), 256), np.tile(_LOWER, _PLACES))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def _segment_words(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of one segment that begins and ends at a word's border."""
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    inside = data[~blank]
    stop = np.cumsum(lengths)
    place = np.arange(len(inside)) - np.repeat(stop - lengths, lengths)
    values = _TABLE[(np.minimum(place, _PLACES - 1) << 8) | inside]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        values[far] = _values(place[far], _LOWER[inside[far]])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return mix64(sums[stop] - sums[stop - lengths] + lengths.astype(np.uint64))


def word_hashes(text: bytes | memoryview) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    if len(data) <= SEGMENT:
        return _segment_words(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + SEGMENT, len(data))
        while end < len(data):  # on to the next white space
            stop = np.flatnonzero(_BLANK[data[end:end + SEGMENT]])
            end = end + int(stop[0]) if len(stop) else min(end + SEGMENT, len(data))
            if len(stop):
                break
        parts.append(_segment_words(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; of fewer words, the whole sequence as one."""
    n = len(words)
    if not n:
        return words
    span = min(width, n)
    h = np.full(n - span + 1, np.uint64(span), np.uint64)
    for i in range(span):
        h = mix64(h * _STEP + words[i:n - span + 1 + i])
    return np.unique(h)


def set_id(shingles: np.ndarray) -> int:
    """One 64-bit number for a whole set, as a signed value."""
    return int(mix64(np.array([mix64(shingles).sum() + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def texts(column: pa.Array) -> Iterator[memoryview | bytes]:
    """The UTF-8 bytes of a string column, without copies; null as empty."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    data = memoryview(buffers[2]) if buffers[2] is not None else memoryview(b"")
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[offsets[i]:offsets[i + 1]] if valid[i] else b""
