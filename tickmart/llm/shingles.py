"""Word shingles as sorted sets of 64-bit numbers, and MinHash signatures of them."""

from __future__ import annotations

import numpy as np

# A-Z in lower case; what is neither letter, digit nor beyond ASCII parts words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word ``data[start:end]``, the same wherever the word stands."""
    inverse = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
    up = powers(len(data), MULTIPLIER)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up, out=sums[1:])
    # what stands in front only scales a word's sum; the inverse power takes that back
    return mix((sums[ends] - sums[starts]) * powers(len(data), inverse)[starts])


def shingle_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """The set of ``size``-word shingles of each text, sorted. A text of fewer words has one shingle,
    all its words; a text without words, or null, none."""
    folded = [(t or b"").translate(FOLD) for t in texts]
    data = np.frombuffer(b" ".join([*folded, b""]) if folded else b"", np.uint8)
    if not len(data):
        return [np.zeros(0, np.uint64) for _ in texts]
    solid = np.concatenate([[False], data != 32, [False]])
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    words = word_numbers(data, starts, ends)
    sizes = np.array([len(t) + 1 for t in folded], np.int64)
    first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
    last = np.append(first[1:], len(words))
    n = max(0, len(words) - size + 1)
    numbers = np.zeros(n, np.uint64)
    for i in range(size):
        numbers = mix(numbers * MULTIPLIER + words[i : i + n])
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(numbers[a : b - size + 1]))
        else:
            one = np.zeros(min(1, b - a), np.uint64)
            for word in words[a:b]:
                one = mix(one * MULTIPLIER + word)
            # not to be mistaken for a whole shingle
            out.append(mix(one + np.uint64(b - a)))
    return out


class MinHash:
    """Minima of ``n`` seeded hashes over a set."""

    def __init__(self, n: int, seed: int = 7):
        seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed << 32))
        self.factors, self.shifts = seeds[:n] | np.uint64(1), seeds[n:]

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of 32-bit minima per set; an empty set has the largest everywhere."""
        out = np.full((len(sets), len(self.factors)), 0xFFFFFFFF, np.uint32)
        full = [i for i, s in enumerate(sets) if len(s)]
        if not full:
            return out
        members = np.concatenate([sets[i] for i in full])
        sizes = np.array([len(sets[i]) for i in full])
        first = np.cumsum(sizes) - sizes
        scratch = np.empty_like(members)
        for k, (factor, shift) in enumerate(zip(self.factors, self.shifts, strict=True)):
            np.multiply(members, factor, out=scratch)
            np.add(scratch, shift, out=scratch)
            out[full, k] = np.minimum.reduceat(scratch, first) >> np.uint64(32)
        return out
