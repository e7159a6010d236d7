"""Word shingles of whole Arrow batches as 64-bit codes, without a loop over words.

Words are runs of anything but ASCII white space, with A-Z in lower case. A code is a
polynomial hash of the word's bytes, then mixed; a shingle's code mixes those of its words.
Two different shingles share a code with a chance of 1 in 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are worked through in pieces of about so many bytes.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 2**64)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit mix that has no two inputs with one output."""
    x = x + np.uint64(salt * 0xD1342543DE82EF95 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _letters() -> np.ndarray:
    """A random number for each byte, the same for A-Z as for a-z."""
    codes = mix(np.arange(1, 257, dtype=np.uint64))
    codes[65:91] = codes[97:123]
    return codes


LETTERS = _letters()
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """The first powers of the base modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        steps = np.full(max(count, 2 * PIECE), base, np.uint64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps)
    return have[:count]


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words in order and the index of each one's text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(LETTERS[data] * _power(BASE, len(data)), out=sums[1:])
    codes = (sums[ends] - sums[starts]) * _power(INVERSE, len(data))[starts]
    return mix(codes), np.searchsorted(offsets, starts, "right") - 1


def shingle_codes(words: np.ndarray, text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all windows of ``width`` words, and each one's text, in order of the text.

    A text of fewer words is one shingle; one without words has none.
    """

    def joined(at: np.ndarray, count: int) -> np.ndarray:
        code = np.zeros(len(at), np.uint64)
        for k in range(count):
            code = mix(code + words[at + k], count)
        return code

    if not len(words):
        return words, text
    at = np.arange(max(0, len(words) - width + 1))
    at = at[text[at] == text[at + width - 1]]
    found, where = [joined(at, width)], [text[at]]
    begin = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.r_[begin, len(words)])
    for few in range(1, width):
        short = begin[count == few]
        if len(short):
            found.append(joined(short, few))
            where.append(text[short])
    codes, texts = np.concatenate(found), np.concatenate(where)
    order = np.argsort(texts, kind="stable")
    return codes[order], texts[order]


def code_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct codes of its shingles; none for NULL."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + PIECE, "right")) - 1)
        to = min(to, len(texts))
        piece = data[bounds[at] : bounds[to]]
        codes, where = shingle_codes(*word_codes(piece, bounds[at : to + 1] - bounds[at]), width)
        ends = np.searchsorted(where, np.arange(at, to + 1) - at)
        for i in range(to - at):
            own = np.sort(codes[ends[i] : ends[i + 1]])
            yield own if len(own) < 2 else own[np.r_[True, own[1:] != own[:-1]]]
        at = to
