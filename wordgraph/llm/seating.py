"""Numbers of tables in Pitman-Yor restaurants: exact conditional draws on numpy columns.

Who sits where is summed out: ``n`` customers of one dish at ``t`` tables have
as many seatings as the generalised Stirling number ``S(n, t)`` of the discount
weighs. Given all other dishes, the chance of ``t`` tables is proportional to

    S(n, t) * product over j < t of (open + discount * j) * (parent + step * j) / (guests + step * j)

where ``open`` is the strength and the discounted tables of the other dishes,
and ``parent / guests`` the chance of the dish in the parent restaurant with the
dish's own tables taken out (``step`` 1: each table opened sends a customer there).

Draws are counters hashed with the keys of a dish, so they depend neither on
batches nor on the order of rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from wordgraph.llm.common import mix64

#: Up to so many customers of a dish the number of tables is drawn from its whole distribution.
EXACT = 1024
#: Metropolis steps of a dish with more customers.
STEPS = 16


def uniform(seed: int, turn: int, step: int, u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that follow from the arguments alone."""
    start = np.array([(seed * 1_000_003 + turn) * 1_000_003 + step], np.uint64)
    h = mix64(mix64(start) ^ mix64(u.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)))
    return (mix64(h + w.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(11)) * 2.0**-53


def lgamma(x: np.ndarray) -> np.ndarray:
    """log gamma for x > 0: Stirling's series eight places further on."""
    x = np.asarray(x, np.float64)
    y = x + 8
    down = np.log(x)
    for i in range(1, 8):
        down = down + np.log(x + i)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) - down


def rising(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """log of ``x (x + 1) ... (x + t - 1)``."""
    far = np.asarray(x) > 1e6
    near = np.where(far, 1.0, x)
    return np.where(far, t * np.log(x + (t - 1) / 2), lgamma(near + t) - lgamma(near))


@lru_cache(maxsize=4)
def _stirling_rows(discount: float, largest: int) -> np.ndarray:
    """log S(n, t) at [n, t] for n up to ``largest``."""
    out = np.full((largest + 1, largest + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, largest + 1)
    for n in range(1, largest):
        stay = np.log(np.maximum(n - t * discount, 1e-300))
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], np.where(t <= n, out[n, 1:] + stay, -np.inf))
    return out


def _limit(n: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """log S(n, t) but for a constant of n, from the recurrence's limit in log n (a Yule process), where n is large."""
    return (t - 1) * (np.log1p(-np.asarray(n, np.float64) ** -d) - np.log(d)) - lgamma(t)


@lru_cache(maxsize=4)
def _corrections(discount: float) -> np.ndarray:
    """What the limit leaves out, by t: taken at n = EXACT, where both are known."""
    t = np.arange(1, EXACT // 2 + 1)
    own = _stirling_rows(discount, EXACT)[EXACT, 1:EXACT // 2 + 1] - _limit(
        np.full(len(t), float(EXACT)), t.astype(float), discount)
    return np.concatenate([[0.0], own])


def log_stirling(n: np.ndarray, t: np.ndarray, discount: float) -> np.ndarray:
    """log S(n, t) for n > EXACT and 0 < t < n, but for a constant of n."""
    more = _corrections(discount)
    # Of t tables at n customers, so many are there at EXACT customers on average.
    early = 1 + (t - 1) * (1 - EXACT ** -discount) / (1 - n.astype(float) ** -discount)
    return _limit(n, t.astype(float), discount) + np.interp(early, np.arange(len(more)), more)


def tables(n: np.ndarray, t: np.ndarray, opening: np.ndarray, discount: float, parent: np.ndarray, guests: np.ndarray,
           step: int, draw) -> np.ndarray:
    """New numbers of tables for dishes with ``n`` customers, now at ``t`` tables.

    ``draw(i, rows)`` gives the i-th uniform numbers of some rows. Dishes up to
    EXACT customers are drawn from the whole conditional distribution; others
    move by Metropolis steps of random widths, which leave it unchanged.
    """
    out = np.minimum(t, n)
    small = np.flatnonzero((n > 1) & (n <= EXACT))
    out[n == 1] = 1
    if len(small):
        rows = _stirling_rows(discount, EXACT)
        # Dishes whose customers have equally many binary digits share a matrix; S(n, t) is 0 beyond t = n.
        digits = np.frexp(n[small])[1]
        for d in np.unique(digits):
            at = small[digits == d]
            width = int(n[at].max())
            j = np.arange(width)
            ratio = (parent[at, None] + step * j) / (guests[at, None] + step * j)
            logs = np.cumsum(np.log((opening[at, None] + discount * j) * ratio), axis=1) + rows[n[at], 1:width + 1]
            mass = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            out[at] = 1 + np.minimum((mass < draw(0, at)[:, None] * mass[:, -1:]).sum(axis=1), n[at] - 1)
    large = np.flatnonzero(n > EXACT)
    if len(large):
        size, now = n[large], np.minimum(out[large], n[large] - 1)
        a, b, c = opening[large] / discount, parent[large], guests[large]

        def target(x):
            up = rising(b, x) - rising(c, x) if step else x * np.log(b / c)
            return log_stirling(size, x, discount) + x * np.log(discount) + rising(a, x) + up

        held = target(now)
        for i in range(STEPS):
            width = np.floor(size ** (draw(3 * i + 1, large) / 2)).astype(np.int64)
            asked = now + np.where(draw(3 * i + 2, large) < 0.5, -width, width)
            inside = (asked >= 1) & (asked < size)
            asked = np.where(inside, asked, now)
            value = target(asked)
            take = inside & (np.log(np.maximum(draw(3 * i + 3, large), 1e-300)) < value - held)
            now, held = np.where(take, asked, now), np.where(take, value, held)
        out[large] = now
    return out
