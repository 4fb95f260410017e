"""Bit-sliced Hamming comparison of 64-bit fingerprints (numpy, inside a task).

A block of fingerprints is stored as 64 bit planes: plane ``j`` holds bit ``j`` of every
fingerprint, 64 of them in a machine word. One XOR with a query's bit ``j`` then yields 64
difference bits at once; carry-save adders sum the planes into counters that are bit-sliced
too. A counter starts at ``2^b - 1 - radius``, so it overflows exactly when the distance
passes the radius; a query whose lanes have all overflowed is abandoned.
"""

from __future__ import annotations

import numpy as np

WORD = 64
#: Planes between two looks at which queries are still open.
STRIDE = 8


def planes_of(prints: np.ndarray) -> np.ndarray:
    """(64, words) bit planes of uint64 fingerprints; lanes beyond the last are zero."""
    n = len(prints)
    width = -(-n // WORD) * WORD
    bits = np.zeros((64, width), np.uint8)
    bits[:, :n] = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").T
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def within(prints: np.ndarray, queries: np.ndarray, radius: int) -> np.ndarray:
    """(queries, words) bits: lane ``i`` is set where query and fingerprint ``i`` differ in <= radius bits."""
    planes = planes_of(prints)
    words, full = planes.shape[1], np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.zeros((len(queries), words), np.uint64)
    digits = max(1, radius.bit_length())
    start = (1 << digits) - 1 - radius
    padding = np.zeros(words * WORD, np.uint8)
    padding[len(prints):] = 1
    padding = np.packbits(padding, bitorder="little").view("<u8")
    live = np.arange(len(queries))
    counts = [np.full((len(queries), words), full if start >> d & 1 else 0, np.uint64) for d in range(digits)]
    over = np.broadcast_to(padding, (len(queries), words)).copy()
    q = queries.astype(np.uint64)
    for j in range(0, 64, 2):
        a = planes[j] ^ (full * (q >> np.uint64(j) & np.uint64(1)))[:, None]
        b = planes[j + 1] ^ (full * (q >> np.uint64(j + 1) & np.uint64(1)))[:, None]
        half = counts[0] ^ a
        carry = counts[0] & a | half & b          # 3:2 compressor on the lowest digit
        counts[0] = half ^ b
        for d in range(1, digits):                # ripple of the carry into the higher digits
            carry, counts[d] = counts[d] & carry, counts[d] ^ carry
        over |= carry
        if (j + 2) % STRIDE == 0:
            keep = (over != full).any(axis=1)
            if not keep.all():
                live, q, over = live[keep], q[keep], over[keep]
                counts = [c[keep] for c in counts]
                if not len(live):
                    return out
    out[live] = ~over
    return out


def groups(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join each connected group of distinct fingerprints to its smallest member's index.

    The rows of ``within`` are an adjacency matrix in bits; each fingerprint is visited once.
    """
    n = len(prints)
    linked = within(prints, prints, radius)
    open_lanes = np.zeros(linked.shape[1], np.uint64)
    padded = np.zeros(len(open_lanes) * WORD, np.uint8)
    padded[:n] = 1
    open_lanes[:] = np.packbits(padded, bitorder="little").view("<u8")
    alone = np.bitwise_count(linked).sum(axis=1) <= 1
    out = []
    for root in np.flatnonzero(~alone).tolist():
        if not int(open_lanes[root // WORD]) >> (root % WORD) & 1:
            continue
        open_lanes[root // WORD] &= np.uint64(~(1 << (root % WORD)) & 0xFFFFFFFFFFFFFFFF)
        frontier = [root]
        while frontier:
            found = linked[frontier.pop()] & open_lanes
            if found.any():
                open_lanes &= ~found
                new = np.flatnonzero(np.unpackbits(found.view(np.uint8), bitorder="little")).tolist()
                out += [(root, i) for i in new]
                frontier += new
    return out
