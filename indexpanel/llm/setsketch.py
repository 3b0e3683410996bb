"""SetSketch: registers with exponentially spaced truncated minima (Ertl, PVLDB 14, 2021), over many sets at once.

Every element of a set draws M points in ascending order, the spacing of M sorted exponentials, and visits the M registers
in an order of its own; a register keeps the least point of the set, rounded to the exponent floor(1 - log_B(point)). The
registers of a union are the maxima of the registers, so sketches merge; two registers are equal with nearly the
probability of the Jaccard similarity J, so their values can be banded. The number of registers where one set's value is
larger, smaller or equal has a likelihood in J, given both set sizes; `likeness` maximises it.
"""

from __future__ import annotations

import numpy as np

from indexpanel.llm.word_hash import mix

M = 211  # prime, so that every step visits all registers
B = 1.001
RATE = 20.0
TOP = 65_534
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def registers(elements: np.ndarray, owner: np.ndarray, n_sets: int) -> np.ndarray:
    """(n_sets, M) uint16 for sets given as 64-bit elements and the number of the set each belongs to."""
    least = np.full(n_sets * M, np.inf)
    seed = mix(elements)
    start, step = seed % np.uint64(M), (seed >> np.uint64(32)) % np.uint64(M - 1) + np.uint64(1)
    place, step, base = start.astype(np.int64), step.astype(np.int64), owner.astype(np.int64) * M
    point = np.zeros(len(elements))
    for j in range(M):
        seed = seed + _GOLDEN
        uniform = ((mix(seed) >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
        point = point - np.log(uniform) / (RATE * (M - j))
        np.minimum.at(least, base + place, point)
        place = place + step
        place[place >= M] -= M
        worst = least.reshape(n_sets, M).max(axis=1)
        live = point < worst[base // M]  # points only grow, so the others can lower no register any more
        if not live.all():
            seed, place, step, base, point = seed[live], place[live], step[live], base[live], point[live]
        if not len(seed):
            break
    with np.errstate(divide="ignore"):
        exponent = np.floor(1.0 - np.log(least) / np.log(B))
    return np.clip(exponent, 0, TOP + 1).astype("<u2").reshape(n_sets, M)


def likeness(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of register rows, given the sizes of the sets."""
    above, below = (a > b).sum(axis=1).astype(float), (a < b).sum(axis=1).astype(float)
    equal = a.shape[1] - above - below
    size_a, size_b = np.maximum(size_a.astype(float), 1e-9), np.maximum(size_b.astype(float), 1e-9)
    u, v = size_a / (size_a + size_b), size_b / (size_a + size_b)
    most = np.minimum(u / v, v / u)

    def share(x):  # probability that a register is larger on the side whose own share of the union is x
        return -np.log1p(-np.clip(x, 0, 1) * (B - 1) / B) / np.log(B)

    def loglik(j):
        up, down = share(u - v * j), share(v - u * j)
        return (above * np.log(np.maximum(up, 1e-12)) + below * np.log(np.maximum(down, 1e-12))
                + equal * np.log(np.maximum(1 - up - down, 1e-12)))

    low, high = np.zeros(len(u)), most
    for _ in range(40):  # the likelihood has one peak: golden-section search
        x, y = high - 0.618033988749895 * (high - low), low + 0.618033988749895 * (high - low)
        left = loglik(x) > loglik(y)
        low, high = np.where(left, low, x), np.where(left, y, high)
    return (low + high) / 2
