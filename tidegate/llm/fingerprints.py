"""64-bit fingerprints in numpy: bit votes, distances, near pairs within sorted runs of keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

U64 = np.uint64
VOTE_ROWS = 1 << 15
SMALL_RUN = 16
NODE_ROWS = 4096
PAIRS_AT_ONCE = 1 << 15


def bit_votes(hashes: np.ndarray, owner_first: np.ndarray, owner_count: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """For each owner of consecutive hashes, how many of them (or what weight) have each bit set; bit 63 first."""
    votes = np.zeros((len(owner_first), 64), np.float64 if weights is not None else np.int64)
    owner = np.repeat(np.arange(len(owner_first)), owner_count)
    for lo in range(0, len(hashes), VOTE_ROWS):
        part = np.ascontiguousarray(hashes[lo : lo + VOTE_ROWS].astype(">u8"))
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        own = owner[lo : lo + VOTE_ROWS]
        cut = np.flatnonzero(np.diff(own, prepend=-1))
        if weights is None:
            votes[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.uint16)
        else:
            votes[own[cut]] += np.add.reduceat(bits * weights[lo : lo + VOTE_ROWS, None], cut, axis=0)
    return votes


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """(n, 64) booleans, bit 63 first, to unsigned integers."""
    return np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> U64(shift))
    return values


def forest(n: int, edges: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each of n nodes."""
    label = np.arange(n)
    for i, j in edges:
        while len(i):
            a, b = label[i], label[j]
            differ = a != b
            i, j, a, b = i[differ], j[differ], a[differ], b[differ]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def star_edges(values: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    member = np.flatnonzero(label != np.arange(len(label)))
    return values[label[member]], values[member]


class GrayTree:
    """Gray-sorted fingerprints under nodes that hold the bit pattern all below them share."""

    FAN = 8

    def __init__(self, values: np.ndarray):
        self.values = values
        all_ones, any_ones = values, values
        self.masks, self.patterns = [np.full(len(values), ~U64(0))], [values]
        while len(all_ones) > 1:
            cut = np.arange(0, len(all_ones), self.FAN)
            all_ones, any_ones = np.bitwise_and.reduceat(all_ones, cut), np.bitwise_or.reduceat(any_ones, cut)
            mask = ~(all_ones ^ any_ones)
            self.masks.append(mask)
            self.patterns.append(all_ones & mask)

    @property
    def height(self) -> int:
        return len(self.masks) - 1

    def size(self, level: int) -> int:
        return len(self.masks[level])


def near_pairs(left: GrayTree, right: GrayTree, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within `radius`, found by descending both trees at once.

    A pair of nodes goes, with all below it, when the bits that both share within already differ in
    more than `radius` places. If both trees are one, each pair comes once.
    """
    same = left is right
    top = max(left.height, right.height)
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        la, lb = min(level, left.height), min(level, right.height)
        differ = np.bitwise_count((left.patterns[la][a] ^ right.patterns[lb][b]) & left.masks[la][a] & right.masks[lb][b])
        near = differ <= radius
        if same and level == 0:
            near &= a < b
        a, b = a[near], b[near]
        if level == 0:
            if len(a):
                yield a, b
            continue
        a, b = _children(a, level - 1, left), _children(b, level - 1, right)
        a, b = np.repeat(a, b.shape[1], axis=1).reshape(-1), np.tile(b, (1, a.shape[1])).reshape(-1)
        keep = (a >= 0) & (b >= 0)
        if same:
            keep &= a <= b
        stack.append((level - 1, a[keep], b[keep]))


def _children(nodes: np.ndarray, level: int, tree: GrayTree) -> np.ndarray:
    if level >= tree.height:
        return nodes[:, None]
    below = nodes[:, None] * tree.FAN + np.arange(tree.FAN)
    return np.where(below < tree.size(level), below, -1)


Search = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


class RunScan:
    """Reads rows sorted by key, and finds links among the values of each key.

    Links of a whole run of one key come as a spanning forest. What may go on elsewhere (the first
    and last run of a partition, a run beyond `NODE_ROWS`) also comes as nodes: pieces of the run,
    to be paired with the other pieces of the same key by a join.
    """

    def __init__(self, search: Search, radius: int):
        self.search, self.radius = search, radius
        self.keys, self.values = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        self.open = True  # the first run kept may have begun in an earlier partition or piece

    def feed(self, keys: np.ndarray, values: np.ndarray, last: bool = False) -> tuple[list, list]:
        """Edges [(a, b)] as arrays, and nodes [(key, values)]."""
        keys, values = np.concatenate([self.keys, keys]), np.concatenate([self.values, values])
        edges, nodes = [], []
        if not len(keys):
            return edges, nodes
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        stop = np.append(start[1:], len(keys))
        if not last:
            keep = start[-1]
            whole = (len(keys) - keep) // NODE_ROWS * NODE_ROWS
            if whole:
                done_to = keep + whole
                start, stop = np.append(start[:-1], keep), np.append(stop[:-1], done_to)
            else:
                done_to = keep
                start, stop = start[:-1], stop[:-1]
        else:
            whole, done_to = 0, len(keys)
        size = stop - start
        small = size <= SMALL_RUN
        run_of = np.repeat(np.arange(len(start)), size)
        is_small = small[run_of]
        for step in range(1, SMALL_RUN):
            at = np.flatnonzero((run_of[:-step] == run_of[step:]) & is_small[:-step]) if len(run_of) > step else []
            if not len(at):
                break
            at = at[np.bitwise_count(values[at] ^ values[at + step]) <= self.radius]
            edges.append((values[at], values[at + step]))
        loose = np.zeros(len(start), bool)
        if len(start):
            loose[0] |= self.open
            loose[-1] |= last or bool(whole)
        for k in np.flatnonzero(~small | loose):
            for lo in range(start[k], stop[k], NODE_ROWS):
                part = values[lo : min(lo + NODE_ROWS, stop[k])]
                if not small[k]:
                    edges.append(self.search(part))
                if loose[k] or size[k] > NODE_ROWS:
                    nodes.append((int(keys[lo]), part))
        self.open = bool(whole) or (self.open and not len(start))
        self.keys, self.values = keys[done_to:], values[done_to:]
        return edges, nodes
