"""Context-tree weighting over bytes: the arithmetic of one set of contexts, in numpy.

A byte is split into eight binary decisions, each with its own context tree, whose
contexts are the bytes before it. A node of depth d keeps how often each bit followed;
its weighted probability is half its own Krichevsky-Trofimov estimate and half the
product of its children's, so that all depths are mixed by how well they predicted
the training bytes. An n-gram is one integer: the nearest context byte on top, the
farthest one next to the lowest byte, which is the byte to predict.
"""

from __future__ import annotations

import numpy as np

LOG_HALF = float(np.log(0.5))
LOG_PI = float(np.log(np.pi))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for x >= 0.5, by Stirling's series after moving x up by eight."""
    product, y = np.ones_like(x, dtype=float), np.asarray(x, dtype=float)
    for step in range(8):
        product = product * (y + step)
    y = y + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of any sequence with these counts."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - LOG_PI - log_gamma(zeros + ones + 1.0)


def ngrams(data: np.ndarray, depth: int) -> np.ndarray:
    """The n-gram that ends at each byte from the depth-th on."""
    n = len(data) - depth
    code = data[depth:].astype(np.int64)
    for back in range(1, depth + 1):
        code |= data[depth - back : depth - back + n].astype(np.int64) << (8 * (depth - back + 1))
    return code


def sum_by(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sums of the values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return (keys[starts], *(np.add.reduceat(v[order], starts) if len(keys) else v[:0] for v in values))


class Level:
    """The nodes of one depth: for each of the eight decisions their keys, bit counts and ln beta."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, below: Level | None):
        self.nodes = []
        for bit in range(8):
            key = codes >> (8 - bit)
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
            is_one = (codes >> (7 - bit)) & 1
            total = np.add.reduceat(counts, starts) if len(key) else counts[:0]
            ones = np.add.reduceat(counts * is_one, starts) if len(key) else counts[:0]
            children = None
            if below is not None:
                deep, _, _, weighted, _ = below.nodes[bit]
                parent = ((deep >> (8 + bit)) << bit) | (deep & ((1 << bit) - 1))
                at = np.searchsorted(key[starts], parent)
                children = np.bincount(at, weights=weighted, minlength=len(starts))
            self.nodes.append(node_values(key[starts], total - ones, ones, children))


def node_values(keys, zeros, ones, children):
    """(keys, zeros, ones, ln of the weighted probability, ln beta); no children: the deepest level."""
    own = log_kt(zeros, ones)
    if children is None:
        return keys, zeros, ones, own, np.full(len(keys), np.inf)
    return keys, zeros, ones, np.logaddexp(own, children) + LOG_HALF, own - children


def levels(codes: np.ndarray, counts: np.ndarray, depth: int, top: int) -> dict[int, Level]:
    """Levels top..depth of the trees over these sorted n-grams."""
    out, below = {}, None
    for d in range(depth, top - 1, -1):
        if d < depth:
            shorter = ((codes >> 16) << 8) | (codes & 255)
            codes, counts = sum_by(shorter, counts)
        below = out[d] = Level(codes, counts, below)
    return out


def predict(codes: np.ndarray, depth: int, trees: dict[int, Level]) -> np.ndarray:
    """ln of the probability of each n-gram's last byte after the others; unseen nodes say one half."""
    total = np.zeros(len(codes))
    for bit in range(8):
        p = np.full(len(codes), 0.5)
        one = ((codes >> (7 - bit)) & 1).astype(bool)
        prefix = (codes & 255) >> (8 - bit)
        for d in range(depth, -1, -1):
            keys, zeros, ones, _, log_beta = trees[d].nodes[bit]
            if not len(keys):
                continue
            wanted = ((codes >> (8 * (depth - d + 1))) << bit) | prefix
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            seen = keys[at] == wanted
            estimate = (np.where(one, ones[at], zeros[at]) + 0.5) / (zeros[at] + ones[at] + 1.0)
            weight = 1 / (1 + np.exp(-np.clip(log_beta[at], -700, 700)))
            p = np.where(seen, weight * estimate + (1 - weight) * p, p)
        total += np.log(p)
    return total
