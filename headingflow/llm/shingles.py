"""Word shingles of many texts at once as 64-bit hashes, and their MinHash sketches."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text hashed at once, but for a longer single word.
PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit value scattered over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base % (1 << 64), dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


@lru_cache(maxsize=1)
def _piece_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_BASE, PIECE + 1), _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def word_hashes(words: bytes) -> np.ndarray:
    """One hash for each word of a byte string whose words stand between single spaces."""
    found = []
    at = 0
    while at < len(words):
        end = len(words)
        if end - at > PIECE:
            end = words.rfind(b" ", at, at + PIECE)
            end = words.find(b" ", at + PIECE) if end < 0 else end
            end = len(words) if end < 0 else end
        data = np.frombuffer(words, dtype=np.uint8, count=end - at, offset=at)
        gaps = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], gaps + 1])
        ends = np.concatenate([gaps, [len(data)]])
        if len(data) <= PIECE:
            power, inverse = _piece_powers()
        else:
            power, inverse = _powers(_BASE, len(data) + 1), _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * inverse[starts]))
        at = end + 1
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(counts: np.ndarray, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of several texts and the text of each, ordered by text.

    ``counts`` are words per text. A text of fewer than ``width`` words has one
    shingle, all its words.
    """
    owner = np.repeat(np.arange(len(counts)), counts)
    total = np.zeros(len(hashes), dtype=np.uint64)
    last = np.maximum(len(hashes) - width + 1, 0)
    factor = 1
    for j in range(width):
        factor = factor * _BASE % (1 << 64)
        total[:last] += hashes[j : j + last] * np.uint64(factor)
    whole = np.zeros(len(hashes), dtype=bool)
    whole[:last] = owner[:last] == owner[width - 1 : width - 1 + last] if last else False
    first = np.cumsum(counts) - counts
    for text in np.flatnonzero((counts > 0) & (counts < width)):
        value, factor = int(counts[text]), 1
        for h in hashes[first[text] : first[text] + counts[text]].tolist():
            factor = factor * _BASE % (1 << 64)
            value += h * factor
        total[first[text]] = value % (1 << 64)
        whole[first[text]] = True
    owner, made = owner[whole], mixed(total[whole])
    order = np.lexsort((made, owner))
    owner, made = owner[order], made[order]
    new = np.ones(len(made), dtype=bool)
    new[1:] = (made[1:] != made[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], made[new]


class Sketcher:
    """MinHash samples folded to band keys and to an odd sketch.

    The odd sketch is a bitmap of ``bits``: each sample, with its place, flips
    one bit. Two sketches differ in about ``bits / 2 * (1 - exp(-2 d / bits))``
    bits if the samples have ``d`` elements that are in one of them only, and
    ``d`` is ``2 * samples * (1 - similarity)``. The bands take the first samples,
    the odd sketch all.
    """

    def __init__(self, bands: int, rows: int, samples: int, bits: int, seed: int = 1):
        self.bands, self.rows, self.n_samples, self.bits = bands, rows, max(samples, bands * rows), bits
        n = self.n_samples
        ladder = mixed(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed << 32))
        self.flips, self.factors = ladder[:n], ladder[n:] | np.uint64(1)

    def samples(self, owner: np.ndarray, made: np.ndarray) -> np.ndarray:
        """One row of samples for each text that has a shingle, in order."""
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        out = np.empty((len(starts), self.n_samples), dtype=np.uint64)
        buffer = np.empty_like(made)
        for i, (flip, factor) in enumerate(zip(self.flips, self.factors, strict=True)):
            np.bitwise_xor(made, flip, out=buffer)
            np.multiply(buffer, factor, out=buffer)
            out[:, i] = np.minimum.reduceat(buffer, starts)
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        keys = np.empty((len(samples), self.bands), dtype=np.uint64)
        for b in range(self.bands):
            total = np.full(len(samples), b + 1, dtype=np.uint64)
            for i in range(b * self.rows, (b + 1) * self.rows):
                total = mixed(total * np.uint64(_BASE) + samples[:, i])
            keys[:, b] = total
        return keys.view(np.int64)

    def odd_sketches(self, samples: np.ndarray) -> np.ndarray:
        places = np.arange(samples.shape[1], dtype=np.uint64) * np.uint64(_BASE)
        bit = (mixed(samples + places) % np.uint64(self.bits)).astype(np.int64)
        bit += np.arange(len(samples))[:, None] * self.bits
        odd = np.bincount(bit.ravel(), minlength=len(samples) * self.bits).astype(np.uint8) & 1
        return np.packbits(odd.reshape(len(samples), self.bits), axis=1).view(">i8").astype(np.int64)


def sketched(
    texts: list[str | None], sketcher: Sketcher, width: int
) -> Iterator[tuple[np.ndarray, list[bytes | None], np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of the texts: set sizes, digests, and for those with words indices, band keys and odd sketches."""
    group: list[bytes] = []
    counts: list[int] = []
    digests: list[bytes | None] = []
    size = 0

    def made():
        n = np.array(counts, dtype=np.int64)
        owner, found = shingles(n, word_hashes(b" ".join(g for g in group if g)), width)
        sizes = np.bincount(owner, minlength=len(n))
        if not len(owner):
            none = np.zeros((0, 0), dtype=np.int64)
            return sizes, digests, np.zeros(0, dtype=np.int64), none, none
        drawn = sketcher.samples(owner, found)
        return sizes, digests, np.flatnonzero(sizes), sketcher.band_keys(drawn), sketcher.odd_sketches(drawn)

    for text in texts:
        words = normal_words(text)
        joined = b" ".join(words)
        group.append(joined)
        counts.append(len(words))
        digests.append(hashlib.blake2b(joined, digest_size=16).digest() if words else None)
        size += len(joined)
        if size >= PIECE:
            yield made()
            group, counts, digests, size = [], [], [], 0
    if group:
        yield made()
