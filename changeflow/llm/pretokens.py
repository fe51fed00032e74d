"""Texts cut into pre-tokens, many at a time, and the distinct ones among them.

The rule is that of the byte-level vocabularies: contractions, runs of letters,
numbers or other signs with one space before them, and the rest of the white space.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

OTHER, LETTER, NUMBER, SPACE, END, UNKNOWN = range(6)
#: Code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Characters cut at once; a longer text makes a chunk of its own.
CHUNK = 3 << 20


@cache
def classes() -> np.ndarray:
    """The class of each code point.  Those this Python does not know are UNKNOWN: a
    tokenizer with newer tables may call them letters."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = NUMBER
        elif kind == "Cn":
            out[c] = UNKNOWN
    out[WHITE_SPACE] = SPACE
    return out


@dataclass
class Cut:
    """Pre-tokens of some texts: ``codes[ends[i-1]:ends[i]]`` are those of text i, as
    positions in ``words``."""

    codes: np.ndarray
    ends: np.ndarray
    words: list[str]


def _starts(points: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point.  END marks stand alone."""
    start = np.empty(len(points), dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    start |= kind == END
    blank = kind == SPACE
    # The last blank before a sign: apart from the blanks before it; a plain space
    # goes with the sign.
    last = np.flatnonzero(blank[:-1] & ~blank[1:] & (kind[1:] != END))
    start[last] = True
    start[last[points[last] == 0x20] + 1] = False
    # Contractions, where a pre-token begins with an apostrophe.
    at = np.flatnonzero((points == 0x27) & start)
    padded = np.concatenate([points, np.zeros(3, dtype=points.dtype)])
    one, two = padded[at + 1], padded[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for hits, width in ((at[short], 2), (at[long], 3)):
        start[hits + 1] = False
        start[np.minimum(hits + width, len(points) - 1)] = True
    return start


def _cut(texts: list[str]) -> Cut:
    """Every text must be free of UNKNOWN code points."""
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
    marks = np.cumsum([len(t) + 1 for t in texts]) - 1
    kind = classes()[points]
    kind[marks] = END
    begin = np.flatnonzero(_starts(points, kind))
    is_end = kind[begin] == END
    data = joined.encode()
    if len(data) != len(points):
        begin = np.flatnonzero((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)[begin]
    offsets = np.append(begin, len(data)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(data))
    encoded = found.filter(pa.array(~is_end)).dictionary_encode()
    ends = np.flatnonzero(is_end) - np.arange(len(texts))
    return Cut(encoded.indices.to_numpy(), ends, encoded.dictionary.to_pylist())


def unknown_points(text: str) -> bool:
    if text.isascii():
        return False
    return bool((classes()[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")] == UNKNOWN).any())


def chunked(texts: list[str]) -> Iterator[slice]:
    """Neighbouring texts of about CHUNK characters."""
    begin = size = 0
    for k, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield slice(begin, k)
            begin, size = k, 0
        size += len(t) + 1
    if begin < len(texts):
        yield slice(begin, len(texts))


def cut_signs(texts: list[str]) -> Cut:
    return _cut(texts)


def cut_blanks(texts: list[str]) -> Cut:
    """Texts cut at ASCII white space."""
    parts = pc.ascii_split_whitespace(pa.array(texts, type=pa.string()))
    encoded = parts.flatten().dictionary_encode()
    ends = parts.offsets.to_numpy()[1:] - parts.offsets.to_numpy()[0]
    return Cut(encoded.indices.to_numpy(), ends, encoded.dictionary.to_pylist())


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of the ranges [start, start + length), one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)
