"""Language-model scores by stupid backoff, computed from hashed n-gram tables.

The corpus itself gives the counts of words and of word pairs, and every text is scored by
the counts of all other texts: its own occurrences are taken off first, exactly, whatever the
count. A pair that some other text has scores the share of its first word's occurrences that
it makes up; any other backs off to the frequency of its second word, times a constant, and a
word that no other text has backs off once more, to the frequency of a single occurrence.

Written as a sum, every word scores alone, and a pair that others have adds a bonus. The
distinct pairs of the documents cross the network once, to the bucket that their hash names: a
bucket has all occurrences of its pairs, so it counts them and scores them. A task sends its
pairs of one bucket as one row of arrays, since rows of their own would take twice the bytes.

No word and no pair is too rare to count; both are known by 64-bit hashes. The tasks hold the
counts of the most frequent words and pairs, so that no bucket and no join has a hot key. How
many are held changes no score.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import groups, id_and_text, map_batches, text_bytes
from quillmark.llm.minhash import mix, word_hashes
from quillmark.sources.staging import stage

# Words and pairs whose counts every task holds.
HELD_WORDS, HELD_PAIRS = 1 << 20, 1 << 16
# A pair with twice this share of all pairs is held: it has this share in some group of texts, and few pairs have.
HOT_SHARE = 2.0**-14
BACKOFF = 0.4
# Scores are summed as integers of this resolution, so that reruns agree to the last bit.
UNIT = float(1 << 20)
# Bytes of text whose words and pairs a task counts at a time.
SPAN_BYTES = 1 << 22
# Pairs that a bucket is to have, and the least number of buckets.
BUCKET_PAIRS, LEAST_BUCKETS = 1 << 20, 128


class Held:
    """Counts of frequent words or pairs, by their hashes, for tasks to hold."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each key, 0 for those that are not held, and which are."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        held = self.keys[at] == keys
        return np.where(held, self.counts[at], 0), held


def hold(table: DataFrame, most: int) -> Held:
    """The keys of ``(key, n)`` with the greatest ``n``: as many whole levels of ``n`` as ``most`` has room for."""
    level = F.floor(F.log2("n") * 16)
    room, least = most, None
    for r in sorted(table.groupBy(level.alias("level")).count().collect(), reverse=True):
        if r["count"] > room:
            break
        room, least = room - r["count"], r["level"]
    return _collected(table.where(F.lit(False) if least is None else level >= least))


def _collected(table: DataFrame) -> Held:
    rows = table.select("key", "n").toArrow()
    return Held(rows["key"].to_numpy().view(np.uint64), rows["n"].to_numpy())


def units(logarithms: np.ndarray) -> np.ndarray:
    return np.rint(logarithms * UNIT).astype(np.int64)


@dataclass
class Span:
    """The distinct words and pairs of each text of a group, in the order of the texts."""

    start: int
    n_words: np.ndarray
    word_text: np.ndarray
    # Place of the word in ``words``, which are all words of the group.
    word_at: np.ndarray
    words: np.ndarray
    word_n: np.ndarray
    # The words of a pair, as places in the columns above.
    first: np.ndarray
    second: np.ndarray
    pair_n: np.ndarray

    @property
    def word(self) -> np.ndarray:
        return self.words[self.word_at]

    def pair(self) -> np.ndarray:
        """The hash of each pair."""
        word = self.word
        return mix(word[self.first] * np.uint64(0x9FB21C651E98DF25) + word[self.second])


def _span(start: int, data: np.ndarray, bounds: np.ndarray) -> Span:
    # Hashing takes some fifty bytes for each byte of text, so it goes piece by piece.
    parts = [word_hashes(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]) for a, b in groups(bounds)]
    words, word = np.unique(np.concatenate([hashes for hashes, _ in parts]), return_inverse=True)
    counts = np.concatenate([counts for _, counts in parts])
    del parts
    text = np.repeat(np.arange(len(counts)), counts)
    own, at, word_n = np.unique(text * len(words) + word, return_inverse=True, return_counts=True)
    del word
    inside = text[1:] == text[:-1]
    del text
    pairs, pair_n = np.unique(at[:-1][inside] * len(own) + at[1:][inside], return_counts=True)
    del at, inside
    divisor = max(len(words), 1)
    return Span(start, counts, own // divisor, own % divisor, words, word_n,
                pairs // max(len(own), 1), pairs % max(len(own), 1), pair_n)


def _spans(batch: pa.RecordBatch) -> Iterator[Span]:
    """The groups of texts of a batch. No array of a group outlives its use, so a task's memory is that of one group."""
    data, bounds = text_bytes(batch.column("text"))
    for start, end in groups(bounds, SPAN_BYTES):
        yield _span(start, data, bounds[start : end + 1])


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of each."""
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, n, len(keys)).astype(np.int64)


def word_and_hot_pair_counts(docs: DataFrame, share: float = HOT_SHARE) -> DataFrame:
    """``(pair, key, n)``: occurrences of each word, and of pairs where they have ``share`` of a group's pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in _spans(batch):
                words, n_words = _summed(span.word, span.word_n)
                pairs, n_pairs = _summed(span.pair(), span.pair_n)
                hot = n_pairs >= span.pair_n.sum() * share
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([False, True], [len(words), hot.sum()])),
                     pa.array(np.concatenate([words, pairs[hot]]).view(np.int64)),
                     pa.array(np.concatenate([n_words, n_pairs[hot]]))], ["pair", "key", "n"])

    counted = id_and_text(docs).select("text").mapInArrow(count, "pair boolean, key bigint, n bigint")
    return counted.groupBy("pair", "key").agg(F.sum("n").alias("n"))


def counts_of(docs: DataFrame, pairs: Held) -> DataFrame:
    """``(key, n)``: all occurrences of the given pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in _spans(batch):
                key = span.pair()
                asked = pairs.find(key)[1]
                key, n = _summed(key[asked], span.pair_n[asked])
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])

    counted = id_and_text(docs).select("text").mapInArrow(count, "key bigint, n bigint")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """What tasks hold: counts of frequent words and pairs, the number of all words, and the constant."""

    words: Held
    pairs: Held
    total: int
    backoff: float

    def others(self, span: Span) -> np.ndarray:
        """Words of all other texts, at least 1, for each text."""
        return np.maximum(self.total - span.n_words, 1)

    def word_units(self, span: Span) -> tuple[np.ndarray, np.ndarray]:
        """What one occurrence of each word scores alone, over the share of one word; and which words are held."""
        n, held = (found[span.word_at] for found in self.words.find(span.words))
        left = n - span.word_n
        return np.where(held, units(np.log(np.where(left > 0, left, self.backoff))), 0), held

    def pair_units(self, span: Span, of_words: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(base, count, is held)``: a pair's bonus without its own count and words that are not held."""
        base = units(np.log(self.others(span)) - np.log(self.backoff))[span.word_text[span.first]]
        base = base - of_words[span.first] - of_words[span.second]
        n, own = self.pairs.find(span.pair())
        return base, n, own & held[span.first] & held[span.second]


def held_scores(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, n_words, score)``: what each text scores by the words and pairs that are held, in ``UNIT``."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, scores = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
        for span in _spans(batch):
            part = slice(span.start, span.start + len(span.n_words))
            of_words, held = model.word_units(span)
            base, n, own = model.pair_units(span, of_words, held)
            left = n - span.pair_n
            gains = np.where(own & (left > 0), span.pair_n * (units(np.log(np.maximum(left, 1))) + base), 0)
            n_words[part] = span.n_words
            # The first word has no pair, so nothing is backed off from.
            scores[part] = (np.maximum(span.n_words - 1, 0) * int(units(np.log(model.backoff)))
                            - span.n_words * units(np.log(model.others(span))))
            np.add.at(scores[part], span.word_text, span.word_n * of_words)
            np.add.at(scores[part], span.word_text[span.first], gains)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words), pa.array(scores)],
                                          ["doc_id", "n_words", "score"])

    return map_batches(id_and_text(docs), run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, score bigint")


def open_words(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, word, weight, own)``: the distinct words of each text that are not held, with their number in it, twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in _spans(batch):
                rare = ~model.words.find(span.words)[1][span.word_at]
                n = pa.array(span.word_n[rare])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(span.word_text[rare] + span.start)),
                     pa.array(span.word[rare].view(np.int64)), n, n], ["doc_id", "word", "weight", "own"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, word bigint, weight bigint, own bigint")


def pair_packets(docs: DataFrame, model: Model, buckets: int) -> DataFrame:
    """The distinct pairs of each text that are not held, one row for each bucket and group of texts.

    ``keys``, ``n`` and ``base`` have an entry for each pair, in the order of the texts; ``ids``
    and ``sizes`` say which text has how many of them. ``open`` says how many words of a pair
    are not held; ``open_word`` and ``open_own`` list these words and their number in the text.
    """

    def lists(values: pa.Array, places: np.ndarray) -> pa.Array:
        """``values``, which are sorted by bucket, as a list for each bucket."""
        return pa.ListArray.from_arrays(pa.array(np.searchsorted(places, np.arange(buckets + 1)).astype(np.int32)), values)

    names = ["bucket", "ids", "sizes", "keys", "n", "base", "open", "open_word", "open_own"]

    def packets(span: Span, ids: pa.Array) -> pa.RecordBatch:
        of_words, held = model.word_units(span)
        base, _, own = model.pair_units(span, of_words, held)
        del of_words
        order = np.flatnonzero(~own)
        key = span.pair()[order]
        bucket = (key % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        bucket, key, order = bucket[by_bucket], key[by_bucket], order[by_bucket]
        del own, by_bucket
        text = span.word_text[span.first[order]]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (bucket[1:] != bucket[:-1]) | (text[1:] != text[:-1])
        opened = np.flatnonzero(fresh)
        made = [
            pa.array(np.arange(buckets, dtype=np.int32)),
            lists(ids.take(pa.array(text[opened] + span.start)), bucket[opened]),
            lists(pa.array(np.diff(np.append(opened, len(order))).astype(np.int32)), bucket[opened]),
            lists(pa.array(key.view(np.int64)), bucket),
            lists(pa.array(span.pair_n[order].astype(np.int32)), bucket),
            lists(pa.array(base[order].astype(np.int32)), bucket),
        ]
        del base, key, text, fresh, opened
        # The words of a pair one after the other, as places.
        words = np.stack([span.first[order], span.second[order]], 1)
        full = pa.array(np.bincount(bucket, minlength=buckets) > 0)
        pair, side = np.nonzero(~held[words])
        word = words[pair, side]
        del words, side, held
        made += [
            lists(pa.array(np.bincount(pair, minlength=len(order)).astype(np.int8)), bucket),
            lists(pa.array(span.word[word].view(np.int64)), bucket[pair]),
            lists(pa.array(span.word_n[word].astype(np.int32)), bucket[pair]),
        ]
        return pa.RecordBatch.from_arrays(made, names).filter(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span in _spans(batch):
                yield packets(span, batch.column("doc_id"))
                del span

    return id_and_text(docs).mapInArrow(
        run, f"bucket int, ids array<{dict(docs.dtypes)['doc_id']}>, sizes array<int>, keys array<bigint>, n array<int>, "
             "base array<int>, open array<tinyint>, open_word array<bigint>, open_own array<int>")


def pair_gains(packets: DataFrame, id_type: str) -> DataFrame:
    """``(doc_id, score, word, weight, own)`` of the pairs that other texts have.

    A row without a word is a bonus; a row with one asks for what an occurrence of the word
    scores alone, times ``weight``, to be added.
    """

    def settle(table: pa.Table) -> pa.Table:
        flat = {c: pa.concat_arrays([chunk.flatten() for chunk in table.column(c).chunks])
                for c in table.column_names if c != "bucket"}
        number = {c: flat[c].to_numpy() for c in flat if c != "ids"}
        n = number["n"].astype(np.int64)
        _, at = np.unique(number["keys"], return_inverse=True)
        left = np.bincount(at, n).astype(np.int64)[at] - n
        seen = left > 0
        gains = np.where(seen, n * (units(np.log(np.maximum(left, 1))) + number["base"]), 0)
        ends = np.concatenate([[0], np.cumsum(number["sizes"])])
        total = np.concatenate([[0], np.cumsum(gains)])
        # A word that is not held is taken off where its pair is one that others have.
        entry = np.repeat(np.arange(len(n)), number["open"])
        asks = np.flatnonzero(seen[entry])
        entry = entry[asks]
        of_text = np.searchsorted(ends, entry, "right") - 1
        sums = total[ends[1:]] - total[ends[:-1]]
        some = np.flatnonzero(sums)
        none = pa.nulls(len(some), pa.int64())
        return pa.table({
            "doc_id": pa.concat_arrays([flat["ids"].take(pa.array(some)), flat["ids"].take(pa.array(of_text))]),
            "score": pa.array(np.concatenate([sums[some], np.zeros(len(asks), np.int64)])),
            "word": pa.concat_arrays([none, pa.array(number["open_word"][asks])]),
            "weight": pa.concat_arrays([none, pa.array(-n[entry])]),
            "own": pa.concat_arrays([none, pa.array(number["open_own"][asks].astype(np.int64))]),
        })

    return packets.groupBy("bucket").applyInArrow(
        settle, f"doc_id {id_type}, score bigint, word bigint, weight bigint, own bigint")


def score_documents(docs: DataFrame, backoff: float = BACKOFF, held_words: int = HELD_WORDS,
                    held_pairs: int = HELD_PAIRS, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """``(doc_id, n_words, score, mean_score)``, one row for each ``doc_id``.

    ``score`` is the sum of the natural logarithms of the stupid-backoff scores of all words of
    the document, given the word before, by the counts of all other rows; ``mean_score``
    divides it by the words. Without words both are 0. Null texts have no words. Rows with one
    id, or with a null id, are scored each by all other rows, and their words and scores are
    added. Where no other row has words, a word scores as one occurrence backed off to.
    Words are what blanks separate, with A to Z folded; texts are read whole.
    """
    id_type = dict(docs.dtypes)["doc_id"]
    counts = stage(word_and_hot_pair_counts(docs), "word-counts")
    words, hot = counts.where("not pair").select("key", "n"), counts.where("pair").select("key", "n")
    total = words.agg(F.sum("n")).first()[0] or 0
    pairs = _collected(counts_of(docs, hold(hot, held_pairs)))
    model = Model(hold(words, held_words), pairs, total, backoff)
    buckets = max(-(-total // bucket_pairs), LEAST_BUCKETS)
    gains = stage(pair_gains(pair_packets(docs, model, buckets), id_type), "pair-gains")
    asked = open_words(docs, model).unionByName(gains.where("word is not null").drop("score"))
    left = F.col("n") - F.col("own")
    alone = F.rint(F.log(F.when(left > 0, left.cast("double")).otherwise(F.lit(backoff))) * UNIT).cast("bigint")
    none = F.lit(0).cast("bigint").alias("n_words")
    answered = asked.join(words.withColumnRenamed("key", "word"), "word").select(
        "doc_id", none, (F.col("weight") * alone).alias("score")
    )
    bonuses = gains.where("word is null").select("doc_id", none, "score")
    scores = held_scores(docs, model).unionByName(answered).unionByName(bonuses)
    sums = scores.groupBy("doc_id").agg(F.sum("n_words").alias("n_words"), F.sum("score").alias("units"))
    score = F.round(F.col("units") / UNIT, 6) + F.lit(0.0)
    mean = F.when(F.col("n_words") > 0, F.round(F.col("units") / UNIT / F.col("n_words"), 6) + F.lit(0.0)).otherwise(0.0)
    return sums.select("doc_id", "n_words", score.alias("score"), mean.alias("mean_score"))
