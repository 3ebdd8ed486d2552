"""Splitting text into the words of a byte-level BPE, for many texts at once.

The rule, as a pattern: ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``.
Classes of characters are looked up in a table and word starts follow from comparing
neighbours, so the cost per character is that of a few array operations.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0

#: Characters of the Unicode property White_Space. Fixed values.
WHITE_SPACE = (0x9, 0xA, 0xB, 0xC, 0xD, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003,
               0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)


@cache
def classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    kinds = "".join(unicodedata.category(chr(c))[0] for c in range(0x110000))
    first = np.frombuffer(kinds.encode("ascii"), np.uint8)
    table[first == ord("L")] = LETTER
    table[first == ord("N")] = NUMBER
    table[list(WHITE_SPACE)] = SPACE
    for c, kind in _late_characters():
        table[c] = kind
    return table


def _late_characters():
    """Letters and numbers that Python's tables do not know yet, as the tokenizers library
    classes them: one that it joins to a letter is a letter."""
    import regex
    from tokenizers.pre_tokenizers import ByteLevel
    unknown = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn")
    splitter = ByteLevel(add_prefix_space=False)
    for kind, pattern, mate in ((LETTER, r"\p{L}", "a"), (NUMBER, r"\p{N}", "1")):
        found = regex.findall(pattern, unknown)
        pieces = splitter.pre_tokenize_str("".join(f"{mate}{c}\n" for c in found))
        begins = {span[0] for _, span in pieces}
        yield from ((ord(c), kind) for k, c in enumerate(found) if 3 * k + 1 not in begins)


def word_starts(chars: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Positions in ``chars`` (code points) at which words start; ``begins`` starts each text."""
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[chars]
    edge = np.zeros(n + 4, bool)
    edge[begins] = True
    edge[n:] = True
    start = edge.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # white space before a word gives its last character away, a blank to the word itself
    after = np.flatnonzero((kind[1:] != SPACE) & (kind[:-1] == SPACE) & ~edge[1:n]) + 1
    start[after - 1] = True
    start[after[chars[after - 1] == 32]] = False
    # contractions; what is left of the letters is a word of its own
    mark = np.flatnonzero((chars == 39) & start[:n])
    if len(mark):
        padded = np.concatenate([chars, np.zeros(4, chars.dtype)])
        a, b = padded[mark + 1], padded[mark + 2]
        free = ~edge[mark + 1]
        one = free & np.isin(a, [ord(c) for c in "stmd"])
        two = free & ~edge[mark + 2] & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e"))
                                        | (a == ord("l")) & (b == ord("l")))
        for hit, length in ((mark[one], 2), (mark[two], 3)):
            start[hit + 1] = False
            start[hit + length] = True
    return np.flatnonzero(start[:n])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def split_words(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Words of all texts in a row, and the number of words of each text."""
    joined = "".join(texts)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    begins = (ends - lengths)[lengths > 0]
    starts = word_starts(code_points(joined), begins)
    places = starts.tolist()
    words = [joined[a:b] for a, b in zip(places, places[1:] + [len(joined)])]
    counts = np.searchsorted(starts, ends) - np.searchsorted(starts, ends - lengths)
    return words, counts


def portions(texts: list[str], chars: int):
    """Runs ``(first, last + 1)`` of texts with about ``chars`` characters in each."""
    first = total = 0
    for k, text in enumerate(texts):
        if total and total + len(text) > chars:
            yield first, k
            first, total = k, 0
        total += len(text)
    if first < len(texts):
        yield first, len(texts)


def row_portions(column: pa.Array, size: int):
    """Runs ``(first, last + 1)`` of rows with about ``size`` bytes in each, before any is decoded."""
    lengths = np.asarray(pc.fill_null(pc.binary_length(column), 0)).astype(np.int64)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(ends):
        last = int(np.searchsorted(ends, ends[first] - lengths[first] + size, "right"))
        yield first, max(last, first + 1)
        first = max(last, first + 1)
