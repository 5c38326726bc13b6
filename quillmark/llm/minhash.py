"""One-permutation MinHash signatures with optimal densification.

One hash of each shingle serves the whole signature: its top bits name a bin and the least
hash of a bin is its value. An empty bin borrows the value of another one, found with a
universal hash of the bin's number and of the attempt, so that two sets borrow alike exactly
as often as they are alike.
"""

import numpy as np

from quillmark.llm.arrow_text import groups

BIN_BITS = 8
BINS = 1 << BIN_BITS

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_random = np.random.default_rng(20240229)
# A 64-bit number for each byte, and the odd base of the running hash of a word.
_BYTES = _random.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 2**64)
_MIX = [np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)]
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def _power(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2^64, kept for the next call."""
    key = str(base)
    made = _powers.get(key)
    if made is None or len(made) < n:
        made = np.full(max(n, 1 << 16), base, np.uint64)
        made[0] = 1
        np.multiply.accumulate(made, out=made)
        _powers[key] = made
    return made[:n]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    Words are what blanks separate, with A to Z folded.
    """
    n = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    letter = ~_BLANK[data]
    opens = letter.copy()
    opens[1:] &= ~letter[:-1]
    closes = letter.copy()
    closes[:-1] &= ~letter[1:]
    edges = bounds[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] = letter[edges]
    closes[edges - 1] = letter[edges - 1]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[_FOLD[data]] * _power(_BASE, len(data)), out=running[1:])
    hashes = mix((running[last] - running[first]) * _power(_UNBASE, len(data))[first] + (last - first).astype(np.uint64))
    return hashes, np.diff(np.searchsorted(first, bounds))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = 2) -> list[np.ndarray]:
    """The distinct shingles of ``size`` words of each text, as sorted hashes.

    A text with fewer words, but any, has its whole word sequence as its only shingle.
    """
    sets: list[np.ndarray] = []
    for first, last in groups(bounds):
        part = data[bounds[first] : bounds[last]]
        words, counts = word_hashes(part, bounds[first : last + 1] - bounds[first])
        ends = np.concatenate([[0], np.cumsum(counts)])
        joined = words
        for k in range(1, size):
            joined = mix(joined[:-1] * np.uint64(0x9FB21C651E98DF25) + words[k:]) if len(joined) else joined
        for start, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
            if end - start >= size:
                own = np.sort(joined[start : end - size + 1])
                fresh = np.ones(len(own), bool)
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                sets.append(own[fresh])
            elif end > start:
                whole = np.array([end - start], np.uint64)
                for word in words[start:end]:
                    whole = mix(whole * np.uint64(0xD6E8FEB86659FD93) + word)
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def _borrowed(attempt: int, bins: np.ndarray) -> np.ndarray:
    """The bin that an empty bin looks at in an attempt, by a universal hash of both."""
    return (mix(bins.astype(np.uint64) + np.uint64((attempt << 32) + 1)) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``BINS`` values for each set that is not empty."""
    values = np.zeros((len(sets), BINS), np.uint64)
    filled = np.zeros((len(sets), BINS), bool)
    for i, own in enumerate(sets):
        bins = (own >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        least = np.ones(len(own), bool)  # sorted, so the first of a bin is its least
        np.not_equal(bins[1:], bins[:-1], out=least[1:])
        values[i, bins[least]] = own[least]
        filled[i, bins[least]] = True
    row, empty = np.nonzero(~filled)
    some = filled.any(axis=1)
    row, empty = row[some[row]], empty[some[row]]
    lent = values.copy()
    attempt = 0
    while len(row):
        attempt += 1
        lender = _borrowed(attempt, empty)
        found = filled[row, lender]
        lent[row[found], empty[found]] = values[row[found], lender[found]]
        row, empty = row[~found], empty[~found]
    return lent


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values; bands that are alike have equal keys."""
    n = signature.shape[1] // rows
    keys = np.tile(np.arange(1, n + 1, dtype=np.uint64), (len(signature), 1))
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + signature[:, k : n * rows : rows])
    return keys


def set_digest(own: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that tell sets apart."""
    return int(np.bitwise_xor.reduce(mix(own))), int(np.add.reduce(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5))))
