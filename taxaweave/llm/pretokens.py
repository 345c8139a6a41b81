"""Cut texts into the pieces between which a byte-level vocabulary never merges.

The cut is the public one of byte_bpe_50k: a contraction ('s 't 're 've 'm 'll
'd), or an optional space with letters, numbers or other characters, or white
space; the last white space character before something else is left to it when
it is a space. Here the cut is found for a whole chunk at once.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from taxaweave.llm.scan import Chunk, worker_cache

#: The characters of white space.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe as a piece of its own.
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")
SPACE, LETTER, NUMBER, OTHER = range(4)


def _classes() -> np.ndarray:
    """The class of every code point, made once in a worker."""
    cache = worker_cache()
    if not hasattr(cache, "classes"):
        table = np.full(0x110000, OTHER, np.uint8)
        for code in range(0x110000):
            kind = unicodedata.category(chr(code))[0]
            if kind in "LN":
                table[code] = LETTER if kind == "L" else NUMBER
        table[WHITE] = SPACE
        cache.classes = table
    return cache.classes


def pieces(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of all rows, in order."""
    code, n = chunk.code, len(chunk.code)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _classes()[code]
    edge = chunk.row_starts()  # edge[i]: a row starts at i, or the text ends
    edge[n] = True
    start = edge[:-1].copy()
    start[1:] |= kind[1:] != kind[:-1]

    follows = ~edge[1:]  # whether the next character is of the same row
    after = np.empty(n, np.uint8)
    after[-1], after[:-1] = SPACE, kind[1:]
    last_white = np.flatnonzero((kind == SPACE) & follows & (after != SPACE))
    start[last_white] = True
    joined = last_white[code[last_white] == 0x20]
    start[joined + 1] = False

    mark = np.flatnonzero((code == 0x27) & start & follows & (after == LETTER))
    if len(mark):
        letter = code[mark + 1]
        one = mark[np.isin(letter, [ord(c) for c in ONE_LETTER])]
        start[one + 1] = False
        one = one[~edge[one + 2]]
        start[one + 2] = True
        two = mark[(mark + 2 < n)]
        two = two[~edge[two + 2]]
        pair = [(code[two + 1] == ord(a)) & (code[two + 2] == ord(b)) for a, b in TWO_LETTERS]
        two = two[np.logical_or.reduce(pair)]
        start[two + 1] = False
        start[two[two + 3 < n] + 3] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], n)
