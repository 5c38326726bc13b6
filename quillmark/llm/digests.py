"""Similarity digests of byte strings in NumPy: improbable windows in chained Bloom filters."""

import base64
from collections.abc import Iterator

import numpy as np

from quillmark.llm.arrow_text import PIECE_BYTES, groups
from quillmark.llm.minhash import mix

WINDOW = 64
# Each run of so many windows votes for its most improbable one.
RUN = 64
LEAST_VOTES = 16
ENTROPY_BINS = 1001
# Windows with less than a tenth of the highest entropy say too little to be features.
LEAST_BIN = 100
FILTER_BITS = 2048
HASHES = 5
FILTER_FEATURES = 160
# Share of the way from chance overlap to full overlap that still counts as chance.
CHANCE = 0.1

_COUNTS = np.arange(WINDOW + 2, dtype=np.float64)
_TERM = np.rint(_COUNTS * np.log2(np.maximum(_COUNTS, 1)) * (1 << 20)).astype(np.int64)
_STEP = np.diff(_TERM)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The entropy of the window that starts at each byte, as a bin from 0 to 1000.

    With counts c, the entropy of a window is 6 - sum(c log2 c) / 64 bits. Moving on by a byte
    changes two counts; how often a byte occurs in the 63 bytes behind and before it gives the
    change, and a running sum the rest. Integers keep the sum exact.
    """
    n = len(data) - WINDOW + 1
    if n < 1:
        return np.zeros(0, np.int64)
    behind, before = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for distance in range(1, WINDOW):
        same = (data[distance:] == data[:-distance]).view(np.uint8)
        behind[:-distance] += same
        before[distance:] += same
    total = np.empty(n, np.int64)
    total[0] = _TERM[np.bincount(data[:WINDOW])].sum()
    np.subtract(_STEP[before[WINDOW:]], _STEP[behind[: n - 1]], out=total[1:])
    np.cumsum(total, out=total)
    return (1000 * ((6 * WINDOW << 20) - total)) // (6 * WINDOW << 20)


def _parts(bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(start, end, bounds)`` of pieces of the data with whole texts, or a part of the runs of one long text."""
    for first, last in groups(bounds):
        start, end = int(bounds[first]), int(bounds[last])
        if last - first > 1 or end - start <= PIECE_BYTES:
            yield start, end, bounds[first : last + 1] - start
        else:
            for at in range(start, max(end - WINDOW - RUN + 2, start + 1), PIECE_BYTES):
                stop = min(at + PIECE_BYTES + WINDOW + RUN - 2, end)
                yield at, stop, np.array([0, stop - at])


def entropy_counts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many windows of the texts have an entropy in each bin."""
    counts = np.zeros(ENTROPY_BINS, np.int64)
    for start, end, inside in _parts(bounds):
        bins = entropy_bins(data[start:end])
        lengths = np.diff(inside)
        whole = np.arange(len(bins)) <= np.repeat(inside[1:], lengths)[: len(bins)] - WINDOW
        if end not in bounds:  # the next part of the text begins with the last windows of this one
            whole[PIECE_BYTES:] = False
        counts += np.bincount(bins[whole], minlength=ENTROPY_BINS)
    return counts


def rarity_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy bin, the rarest first."""
    ranks = np.empty(ENTROPY_BINS, np.int64)
    ranks[np.lexsort((np.arange(ENTROPY_BINS), counts))] = np.arange(ENTROPY_BINS)
    return ranks


def _votes(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows that some run votes for, as positions in order, and their votes."""
    places, votes = [], []
    for start, end, inside in _parts(bounds):
        bins = entropy_bins(data[start:end])
        if not len(bins):
            continue
        lengths = np.diff(inside)
        kind = np.int32 if len(bins) < 1 << 20 else np.int64
        shift = 20 if kind is np.int32 else 40
        at = np.arange(len(bins), dtype=kind)
        none = np.iinfo(kind).max
        key = np.full(len(bins) + RUN - 1, none, kind)
        owner_end = np.repeat(inside[1:], lengths)[: len(bins)]
        good = (at <= owner_end - WINDOW) & (bins >= LEAST_BIN)
        key[: len(bins)][good] = (ranks.astype(kind)[bins[good]] << shift) | at[good]
        least, step = key, 1
        while step < RUN:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        # A text of so few windows that they are no full run is one run.
        run_end = np.repeat(inside[:-1] + np.maximum(lengths - WINDOW - RUN + 1, 0), lengths)[: len(bins)]
        run_end[np.repeat(lengths, lengths)[: len(bins)] < WINDOW] = -1
        chosen = least[(at <= run_end) & (least != none)] & ((1 << shift) - 1)
        count = np.bincount(chosen, minlength=1)
        place = np.flatnonzero(count)
        places.append(place + start)
        votes.append(count[place])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, index = np.unique(np.concatenate(places), return_inverse=True)
    return place, np.bincount(index, np.concatenate(votes), len(place)).astype(np.int64)


def features(data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, hash)`` of the distinct features of each text, in the order of the text.

    A text without features, because it is short or dull, is one feature as a whole.
    """
    lengths = np.diff(bounds)
    place, votes = _votes(data, bounds, ranks)
    text = np.searchsorted(bounds, place, "right") - 1
    runs = np.maximum(lengths - WINDOW - RUN + 2, 1)
    needed = np.minimum(LEAST_VOTES, np.maximum(runs // 4, 1))
    chosen = votes >= needed[text]
    place, text = place[chosen], text[chosen]
    hashes = np.zeros(len(place), np.uint64)
    for start in range(0, len(place), 1 << 15):
        rows = data[place[start : start + (1 << 15), None] + np.arange(WINDOW)]
        found = np.zeros(len(rows), np.uint64)
        for number in rows.view("<u8").T:
            found = mix(found * np.uint64(0x9FB21C651E98DF25) + number)
        hashes[start : start + (1 << 15)] = found
    plain = np.flatnonzero((np.bincount(text, minlength=len(lengths)) == 0) & (lengths > 0))
    whole = [_whole_hash(data[bounds[i] : bounds[i + 1]]) for i in plain.tolist()]
    text = np.concatenate([text, plain])
    hashes = np.concatenate([hashes, np.array(whole, np.uint64)])
    order = np.lexsort((np.arange(len(text)), hashes, text))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    first = np.sort(order[fresh])
    first = first[np.argsort(text[first], kind="stable")]
    return text[first], hashes[first]


def _whole_hash(data: np.ndarray) -> np.uint64:
    words = np.zeros(-(-len(data) // 8) * 8, np.uint8)
    words[: len(data)] = data
    numbers = mix(words.view("<u8") + np.arange(1, len(words) // 8 + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix(np.array([np.bitwise_xor.reduce(numbers) + np.uint64(len(data))]))[0]


class Digests:
    """Digests of some texts: chained filters as rows of bits, and the features in each."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, ranks: np.ndarray):
        n = len(bounds) - 1
        text, hashes = features(data, bounds, ranks)
        per_text = np.bincount(text, minlength=n)
        ordinal = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        per_chain = -(-per_text // FILTER_FEATURES)
        self.starts = np.concatenate([[0], np.cumsum(per_chain)])
        row = self.starts[text] + ordinal // FILTER_FEATURES
        bits = np.zeros((self.starts[-1], FILTER_BITS), bool)
        for k in range(HASHES):
            bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = True
        self.bits = np.packbits(bits, axis=1)
        self.ones = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        self.sizes = np.bincount(row, minlength=self.starts[-1])

    def text(self, i: int) -> str:
        """The digest as text: for each filter the number of features and the bits; empty for an empty text."""
        return "|".join(
            f"{self.sizes[r]}:{base64.b64encode(self.bits[r].tobytes()).decode()}"
            for r in range(self.starts[i], self.starts[i + 1])
        )

    def chain(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = slice(self.starts[i], self.starts[i + 1])
        return self.bits[part], self.ones[part], self.sizes[part]


def likeness(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...]) -> float:
    """Likeness of two chains of filters, 0 to 1.

    Each filter of the shorter chain counts with its best partner, weighted by its features.
    The bits that two filters share count from what chance gives to what is possible. Two
    empty digests are alike, an empty one and another are not.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    if (len(b[0]), b[2].sum()) < (len(a[0]), a[2].sum()):
        a, b = b, a
    best = np.zeros(len(a[0]))
    for i in range(len(a[0])):
        shared = np.bitwise_count(a[0][i] & b[0]).sum(axis=1, dtype=np.int64)
        most = np.minimum(a[1][i], b[1])
        chance = a[1][i] * b[1] / FILTER_BITS
        least = chance + CHANCE * (most - chance)
        score = np.clip((shared - least) / np.maximum(most - least, 1e-9), 0, 1)
        best[i] = np.where(shared == np.maximum(a[1][i], b[1]), 1.0, score).max()
    return float(np.round((best * a[2]).sum() / a[2].sum(), 6))
