"""Groups of equal substrings of a fixed length, from a Burrows-Wheeler transform.

Intervals of the transform are extended backwards, breadth first: the intervals
of all strings of length l give those of length l + 1, and each new right edge
marks a place whose longest common prefix with its neighbour is l. Prefix values
so come out in increasing order, and the search stops at the wanted length; what
is not marked by then shares at least so much. (After Beller, Gog, Ohlebusch and
Schnattinger, "Computing the longest common prefix array based on the
Burrows-Wheeler transform".)
"""

from __future__ import annotations

import numpy as np

#: Symbols packed into the first sort key, 9 bits each.
_PACKED = 7


def suffix_order(symbols: np.ndarray, length: int) -> np.ndarray:
    """Positions ordered by at least the ``length`` symbols that start there."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.uint64), np.zeros(_PACKED, np.uint64)])
    key = np.zeros(n, np.uint64)
    for i in range(_PACKED):
        key = (key << np.uint64(9)) | padded[i:i + n]
    width, bits = _PACKED, n.bit_length()
    together = 64 // bits  # ranks that fit into one key
    while True:
        order = np.argsort(key, kind="stable")
        if width >= length:
            return order
        ordered = key[order]
        rank = np.zeros(n + (together - 1) * width, np.uint64)  # 0 behind the end
        rank[order] = np.cumsum(np.r_[np.uint64(1), (ordered[1:] != ordered[:-1]).astype(np.uint64)])
        key = rank[:n].copy()
        for i in range(1, together):
            key = (key << np.uint64(bits)) | rank[i * width:i * width + n]
        width *= together


def marked_edges(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place in ``order``: whether fewer than ``length`` symbols are
    shared with the place before. Symbol 0 separates texts: strings that hold it
    are not extended, so edges next to them may stay unmarked."""
    n = len(symbols)
    transform = symbols[order - 1]  # position 0 wraps to the last symbol, a separator
    last_to_first = np.empty(n, np.int64)
    last_to_first[np.argsort(transform, kind="stable")] = np.arange(n)
    first = np.concatenate([[-1], symbols[order].astype(np.int32), [-1]])
    marked = np.zeros(n + 1, bool)
    marked[0] = True
    owner = np.full(n + 2, -1, np.int64)  # shifted by one, like ``first``
    lefts, ends = np.array([0]), np.array([n])
    stamp = 0
    for _ in range(length):
        if not len(lefts):
            break
        sizes = ends - lefts
        stops = np.cumsum(sizes)
        rows = np.repeat(lefts - (stops - sizes), sizes) + np.arange(stops[-1])
        inside = transform[rows] > 0
        rows = rows[inside]
        places = last_to_first[rows] + 1
        own = np.repeat(np.arange(stamp, stamp + len(sizes)), sizes)[inside]
        stamp += len(sizes)
        owner[places] = own
        is_last = (owner[places + 1] != own) | (first[places + 1] != first[places])
        is_first = (owner[places - 1] != own) | (first[places - 1] != first[places])
        ends = np.sort(places[is_last])
        lefts = np.sort(places[is_first]) - 1
        new = ~marked[ends]
        lefts, ends = lefts[new], ends[new]
        marked[ends] = True
    return marked[:n]


def least_owner(texts: list[bytes], owners: np.ndarray, length: int) -> np.ndarray:
    """For each ``length``-byte window of the texts, one text after another: the
    least owner of a text that holds the same window."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    symbols = np.frombuffer(b"\0" + b"\0".join(texts) + b"\0", np.uint8).astype(np.uint16) + np.uint16(1)
    stops = np.cumsum(sizes + 1)
    symbols[np.r_[0, stops]] = 0
    windows = np.maximum(sizes - length + 1, 0)
    ends = np.cumsum(windows)
    starts = np.repeat(stops - sizes - (ends - windows), windows) + np.arange(ends[-1] if len(ends) else 0)
    least = np.full(len(symbols), np.iinfo(np.int64).max)
    least[starts] = np.repeat(owners, windows)
    order = suffix_order(symbols, length)
    edges = np.flatnonzero(marked_edges(symbols, order, length))
    groups = np.minimum.reduceat(least[order], edges)
    least[order] = np.repeat(groups, np.diff(np.r_[edges, len(symbols)]))
    return least[starts]
