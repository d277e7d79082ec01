"""Simple-8b word-aligned coding of unsigned integers, in blocks that are coded and decoded as arrays.

A 64-bit word has a selector in its upper four bits and values in the other 60, the first lowest.
Fixed table: selector, values per word, bits per value.
    1: 120 x 0    2: 60 x 1    3: 30 x 2    4: 20 x 3    5: 15 x 4
    6: 12 x 5     7: 10 x 6    8: 8 x 7     9: 7 x 8    10: 6 x 10
   11: 5 x 12    12: 4 x 15   13: 3 x 20   14: 2 x 30   15: 1 x 60
Selector 0 is the escape for values of more than 60 bits: a pair of words, the upper and the lower
half of one value. A word never crosses a block, so a block can be decoded from its offset alone.
"""

from __future__ import annotations

import numpy as np

COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
BLOCK = 512


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """(words uint64, first word of each block and one more) of unsigned ``values``."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // block)
    width = np.full(blocks * block, 255, np.uint8)
    # Bit lengths, by the exponents of the halves, which a float64 holds exactly.
    upper = values >> np.uint64(32)
    width[:n] = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]
    if upper.any():
        width[:n] = np.where(upper > 0, 32 + np.frexp(upper.astype(np.float64))[1], width[:n])
    # Widest of the next 1, 2, 4, ... values within the block; nothing fits beyond its end.
    rows = np.full((blocks, block + 128), 255, np.uint8)
    rows[:, :block] = width.reshape(blocks, block)
    widest = {1: rows}
    for k in (1, 2, 4, 8, 16, 32):
        w = widest[k].copy()
        w[:, :-k] = np.maximum(widest[k][:, :-k], widest[k][:, k:])
        w[:, -k:] = 255
        widest[2 * k] = w
    best = np.zeros((blocks, block), np.uint8)
    for s in range(15, 0, -1):  # later ones hold more values and win
        c, b = COUNTS[s], BITS[s]
        half = 1 << (c.bit_length() - 1)
        fits = np.maximum(widest[half][:, :block], widest[half][:, c - half : c - half + block]) <= b
        best = np.where(fits, np.uint8(s), best)
    counts = np.array(COUNTS)
    size = np.full(blocks, block)
    if blocks:
        size[-1] = n - (blocks - 1) * block
    chosen = np.full(blocks * block, 255, np.uint8)
    live, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(live):  # all blocks a word at a time
        s = best[live, at]
        chosen[live * block + at] = s
        at = at + counts[s]
        more = at < size[live]
        live, at = live[more], at[more]
    starts = np.flatnonzero(chosen != 255)
    sel = chosen[starts]
    place = np.cumsum(1 + (sel == 0)) - (1 + (sel == 0))
    words = np.zeros(int(place[-1]) + 1 + int(sel[-1] == 0) if len(sel) else 0, np.uint64)
    for s in range(1, 16):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            w = np.full(len(mine), s << 60, np.uint64)
            if BITS[s]:
                for i in range(COUNTS[s]):
                    w |= values[starts[mine] + i] << np.uint64(i * BITS[s])
            words[place[mine]] = w
    mine = np.flatnonzero(sel == 0)
    words[place[mine]] = values[starts[mine]] >> np.uint64(32)
    words[place[mine] + 1] = values[starts[mine]] & np.uint64(0xFFFFFFFF)
    first = np.searchsorted(starts, np.arange(blocks) * block)
    return words, np.append(place[first], len(words)).astype(np.int64)


def decode(words: np.ndarray) -> np.ndarray:
    """The values of whole blocks."""
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[sel]
    pair = np.flatnonzero(sel == 0)
    counts[pair[1::2]] = 0
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(2, 16):
        mine = np.flatnonzero(sel == s)
        if len(mine):
            w, mask = words[mine], np.uint64((1 << BITS[s]) - 1)
            for i in range(COUNTS[s]):
                out[at[mine] + i] = (w >> np.uint64(i * BITS[s])) & mask
    out[at[pair[::2]]] = words[pair[::2]] << np.uint64(32) | words[pair[1::2]]
    return out
