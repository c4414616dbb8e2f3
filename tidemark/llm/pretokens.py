"""Pre-tokenisation without a regular expression.

Each code point becomes a symbol (its class, with what the rule needs to know of the next ones);
a symbol is a function from state to state, and functions compose associatively. So blocks of
symbols are composed side by side, the block functions are scanned, and a second pass knows
the state before every symbol. A token starts where the table of starts says so.

The rule: one of the endings 's 't 're 've 'm 'll 'd; or letters, digits or other visible
characters, each with at most one space (U+0020) before; or white space, whose last character
is left to what follows.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

#: Symbols.
LETTER, DIGIT, OTHER, SPACE, LAST, WHITE, END1, END2, RESET = range(9)
#: States: none open; a space that may be a prefix; open letters, digits, others, white space; one or two letters of an ending still to come.
NONE, PREFIX, LETTERS, DIGITS, OTHERS, WHITES, ONE, TWO = range(8)
#: White space as Unicode's property has it (fixed values).
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters after an apostrophe that make an ending (fixed values).
ENDINGS1, ENDINGS2 = "stmd", ("re", "ve", "ll")
BLOCK = 64


@lru_cache(1)
def classes() -> np.ndarray:
    """LETTER, DIGIT, OTHER or WHITE for every code point."""
    kinds = {"L": LETTER, "N": DIGIT}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = WHITE
    return table


@lru_cache(1)
def machine() -> tuple[np.ndarray, np.ndarray]:
    """(next state, starts a token), each by state * 9 + symbol."""
    after, starts = np.zeros((8, 9), np.uint8), np.ones((8, 9), bool)
    for state in range(8):
        for symbol, run in ((LETTER, LETTERS), (DIGIT, DIGITS), (OTHER, OTHERS)):
            after[state, symbol] = run
            starts[state, symbol] = state not in (PREFIX, run)
        if state in (ONE, TWO):
            after[state, LETTER], starts[state, LETTER] = (NONE if state == ONE else ONE), False
        after[state, SPACE], after[state, LAST] = PREFIX, NONE
        after[state, WHITE], starts[state, WHITE] = WHITES, state != WHITES
        for symbol, run in ((END1, ONE), (END2, TWO)):
            joins = state in (PREFIX, OTHERS)
            after[state, symbol], starts[state, symbol] = (OTHERS, False) if state == OTHERS else (OTHERS, state != PREFIX) if joins else (run, True)
    after[:, RESET] = NONE
    return after.ravel(), starts.ravel()


def symbols(points: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """points: code points of texts that each end with one place marked in `reset`."""
    out = classes()[points]
    out[reset] = RESET
    white = out == WHITE
    last = np.zeros(len(out), bool)
    last[:-1] = white[:-1] & ~white[1:] & (out[1:] != RESET)
    out[last] = LAST
    out[last & (points == 0x20)] = SPACE
    quote = np.flatnonzero((points == 0x27) & ~reset)
    if len(quote):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        first, second = padded[quote + 1], padded[quote + 2]
        out[quote[np.isin(first, [ord(c) for c in ENDINGS1])]] = END1
        for a, b in ENDINGS2:
            out[quote[(first == ord(a)) & (second == ord(b))]] = END2
    return out


def starts(points: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """True where a token starts (and at each reset)."""
    n, (after, marks) = len(points), machine()
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, RESET, np.uint8)
    grid[:n] = symbols(points, reset)
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    made = np.repeat(np.arange(8, dtype=np.uint8)[:, None], rows, 1)  # the function of each block so far
    for column in grid:
        made = after[made * np.uint8(9) + column]
    prefix, jump = made.copy(), 1  # scan of the blocks' functions by doubling
    while jump < rows:
        fixed = (prefix == prefix[:1]).all()  # constant functions: what came before them doesn't matter
        if fixed:
            break
        prefix[:, jump:] = np.take_along_axis(prefix[:, jump:], prefix[:, :-jump].astype(np.intp), 0) if jump < rows else prefix
        jump *= 2
    state = np.concatenate([[NONE], prefix[NONE, :-1]]).astype(np.uint8)
    out = np.empty((BLOCK, rows), bool)
    for k, column in enumerate(grid):
        cell = state * np.uint8(9) + column
        out[k] = marks[cell]
        state = after[cell]
    return out.T.ravel()[:n]


def slices(texts: list[str]) -> list[list[str]]:
    """The tokens of each text."""
    if not texts:
        return []
    joined = "\0".join(texts) + "\0"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    reset = np.zeros(len(points), bool)
    reset[ends] = True
    marks = starts(points, reset)
    marks[reset] = True
    cuts = np.flatnonzero(marks)
    first = np.searchsorted(cuts, np.concatenate([[0], ends[:-1] + 1]))
    stop = np.searchsorted(cuts, ends)
    places = cuts.tolist()
    return [[joined[a:b] for a, b in zip(places[i:j], places[i + 1 : j + 1])] for i, j in zip(first.tolist(), stop.tolist())]
