"""ProbMinHash signatures of word shingles, vectorised over the texts of a batch."""

from __future__ import annotations

from collections import Counter

import numpy as np
from xxhash import xxh3_64_intdigest

from .common import byte_words

SHINGLE_WORDS = 5
#: A prime, so that steps of any size visit every register; BANDS * BAND_ROWS of them are banded.
REGISTERS = 163
BANDS, BAND_ROWS = 40, 4

_ODD = np.array(
    [xxh3_64_intdigest(f"shingle {i}".encode()) | 1 for i in range(max(SHINGLE_WORDS, BAND_ROWS))], np.uint64
)


def mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """Well spread 64-bit values for 64-bit values and a salt (the finisher of splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct runs of ``size`` words, and how often each stands.

    A text of fewer words has one shingle of all its words; one without words has none.
    """
    words = byte_words(text)
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            total += mixed(hashes[i : len(hashes) - width + 1 + i], i + 1) * _ODD[i]
    return np.unique(mixed(total, 0), return_counts=True)


def weights(counts: np.ndarray) -> np.ndarray:
    """Weight of a shingle by how often it stands: repeats count, but ever less."""
    return 1.0 + np.log(counts)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """A matrix of one row per set: for each register the shingle that arrives there first.

    Each shingle arrives at the registers one after the other, in an order of
    its own, at the times of a Poisson process whose rate is its weight; the
    pauses grow as registers are used up, so that a shingle's times at the
    registers are independent exponentials. Two sets agree at a register with
    their probability Jaccard similarity. A shingle stops as soon as its next
    arrival is later than the latest of its set's registers: all later ones
    would change nothing. Rows of sets without shingles are zero.
    """
    n = len(sets)
    shingle = np.concatenate([s for s, _ in sets]) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s, _ in sets])
    pause = 1.0 / weights(np.concatenate([c for _, c in sets])) if sets else np.empty(0)
    times = np.full(n * registers, np.inf)
    first = np.zeros(n * registers, np.uint64)
    at = (mixed(shingle, 1) % np.uint64(registers)).astype(np.int64)
    step = (mixed(shingle, 2) % np.uint64(registers - 1)).astype(np.int64) + 1
    now = np.zeros(len(shingle))
    for turn in range(registers):
        if not len(shingle):
            break
        share = ((mixed(shingle, 3 + turn) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        now = now - np.log(share) * pause / (registers - turn)
        place = owner * registers + at
        np.minimum.at(times, place, now)
        won = times[place] == now
        first[place[won]] = shingle[won]
        latest = times.reshape(n, registers).max(axis=1)
        go = now < latest[owner]
        at = (at[go] + step[go]) % registers
        shingle, owner, pause, now, step = shingle[go], owner[go], pause[go], now[go], step[go]
    return first.reshape(n, registers)


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """Per row and band one key; equal in two rows where all registers of the band agree."""
    grouped = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    with np.errstate(over="ignore"):
        total = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
        for i in range(rows):
            total = mixed(total * _ODD[i] + grouped[:, :, i], i + 1)
    return total.view(np.int64)


def digest(signature: np.ndarray) -> np.ndarray:
    """Two bytes a register, enough to estimate how many registers agree."""
    return (mixed(signature, 7) >> np.uint64(48)).astype("<u2")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two sets of weighted shingles, exactly; 0 if one is empty.

    It sums, over each shingle d of both sets, 1 / sum over e of max(a_e / a_d, b_e / b_d),
    which is what registers of :func:`signatures` agree with. The larger term of e is
    that of ``a`` where e weighs at least as much more there, against ``b``, than d
    does: with shingles in order of that ratio the inner sum is one running sum from
    each end, so no pair of shingles is looked at. Texts in which no shingle stands
    more often than in the other have the plain Jaccard similarity of their sets.
    """
    both, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = weights(a[1]), weights(b[1])
    only_x, only_y = x.sum() - x[at].sum(), y.sum() - y[bt].sum()
    x, y = x[at], y[bt]
    ratio, group = np.unique(x / y, return_inverse=True)
    from_x, from_y = np.bincount(group, x, len(ratio)), np.bincount(group, y, len(ratio))
    above = only_x + np.cumsum(from_x[::-1])[::-1]  # a's weights where the ratio is that of d or more
    below = only_y + np.cumsum(from_y) - from_y  # b's where it is less
    return float((1.0 / (above[group] / x + below[group] / y)).sum())


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Share of distinct shingles that two sets have in common; 0 if both are empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


def probability_jaccard(x: Counter, y: Counter) -> float:
    """What a register estimates, by its definition: small sets only, for checks."""
    return sum(
        1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys()
    )
