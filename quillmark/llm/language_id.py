"""Language identification from averaged subword embeddings.

A text is the average of the embeddings of its hashed byte n-grams, and a linear softmax over
that average gives the language. Embeddings and softmax are trained together by stochastic
gradient descent in NumPy. A temperature fitted on a calibration part makes the scores
probabilities, and the calibration part also sets the two bounds below which a text is
rejected: its score, and its share of n-grams that training has met.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import free_name, id_and_text, map_batches, pieces, text_bytes

UNKNOWN = "und"
N_GRAMS = (2, 3, 4)
BUCKET_BITS = 16
DIMENSIONS = 16
# Expected number of training texts of each language: the bound of the sample.
TEXTS_PER_LANGUAGE = 400
# Languages that a model may know.
MOST_LANGUAGES = 256
EPOCHS = 6
# Share of calibration texts that each bound may reject.
REJECTED_SHARE = 0.0005

# A to Z folded; letters and all bytes of other scripts kept; everything else a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_BREAKS = _FOLD == 32
_MULTIPLIERS = {2: 2654435761, 3: 2246822519, 4: 3266489917}


def ngram_buckets(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(text number, bucket)`` of the n-grams of each text that hold no blank inside.

    Runs of bytes that are no letters are one blank, and so are the ends of a text: an
    n-gram with a blank at an end is a prefix or suffix of a word.
    """
    lengths = np.diff(bounds)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    padded = np.full(len(data) + len(lengths) + 1, 32, np.uint8)
    owner = np.zeros(len(padded), np.int64)
    at = np.arange(len(data)) + text_of + 1
    padded[at] = _FOLD[data]
    owner[at] = text_of
    owner[bounds[1:] + np.arange(len(lengths)) + 1] = np.arange(len(lengths))  # the blank behind a text is its own
    kept = np.ones(len(padded), bool)
    kept[1:] = (padded[1:] != 32) | (padded[:-1] != 32)
    letters, owner = padded[kept], owner[kept]
    wide = letters.astype(np.uint32)
    blank = letters == 32
    owners, buckets = [], []
    packed, inner = wide.copy(), None
    for n in range(2, max(N_GRAMS) + 1):
        if len(letters) < n:
            break
        packed = packed[:-1] | (wide[n - 1 :] << np.uint32(8 * (n - 1)))
        # Blanks strictly inside rule an n-gram out.
        inner = np.zeros(len(packed), bool) if n == 2 else inner[:-1] | blank[n - 2 : len(letters) - 1]
        if n in N_GRAMS:
            good = ~inner
            mixed = packed[good] * np.uint32(_MULTIPLIERS[n])
            buckets.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(2246822507) >> np.uint32(32 - BUCKET_BITS))
            # A blank in front belongs to the text in front; its n-gram to the text behind.
            owners.append(owner[: len(packed)][good] if n == 1 else owner[1 : len(packed) + 1][good])
    if not buckets:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(owners), np.concatenate(buckets)


@dataclass
class LanguageModel:
    """``table`` holds, for each bucket, its part of the logits and whether training met it."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least_score: float
    least_known: float


def _probabilities(logits: np.ndarray, temperature: float) -> np.ndarray:
    scaled = logits / temperature
    scaled = np.exp(scaled - scaled.max(axis=1, keepdims=True))
    return scaled / scaled.sum(axis=1, keepdims=True)


def text_logits(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the table's rows, and number of n-grams, for each text."""
    n = len(bounds) - 1
    sums, counts = np.zeros((n, table.shape[1])), np.zeros(n, np.int64)
    for first, part, inside in pieces(data, bounds, _BREAKS):
        texts, buckets = ngram_buckets(part, inside)
        for k in range(table.shape[1]):
            found = np.bincount(texts, table[buckets, k], len(inside) - 1)
            sums[first : first + len(found), k] += found
        found = np.bincount(texts, minlength=len(inside) - 1)
        counts[first : first + len(found)] += found
    return sums, counts


def labelled_sample(docs: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE,
                    most_languages: int = MOST_LANGUAGES) -> DataFrame:
    """``(lang, part, buckets, counts)`` of a sample of the labelled documents.

    A language gives at most ``texts_per_language`` texts, all different, drawn by their hashes; languages beyond
    the ``most_languages`` with most texts give none and are never predicted. A text is at most one entry
    for each bucket. So the sample is bounded by these numbers, whatever repeats in the corpus.
    """
    labelled = docs.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("key"))
    # Different texts, not rows: a text that a language repeats would leave no room for the others.
    sizes = labelled.groupBy("lang").agg(F.approx_count_distinct("key").alias("n"))
    sizes = sizes.orderBy(F.desc("n"), "lang").limit(most_languages)
    drawn = F.pmod("key", F.lit(1 << 40)) / F.lit(float(1 << 40))
    some = labelled.join(F.broadcast(sizes), "lang").where(drawn * F.col("n") < 2 * texts_per_language)
    # Copies of a text are one row a task before they are shuffled.
    single = some.groupBy("lang", "key").agg(F.first("text").alias("text"))
    order = F.row_number().over(W.partitionBy("lang").orderBy(drawn, "key"))
    sample = single.withColumn("at", order).where(F.col("at") <= texts_per_language)
    # One text in five calibrates; the hash is another one, so the parts are independent.
    part = F.pmod(F.xxhash64(F.lit("part"), "text"), F.lit(5)).cast("int")

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = text_bytes(batch.column("text"))
        buckets, counts = [], []
        for i in range(batch.num_rows):
            met, n = np.zeros(0, np.uint32), np.zeros(0, np.int64)
            one = bounds[i : i + 2] - bounds[i]
            total = np.zeros(1 << BUCKET_BITS, np.int32)
            for _, piece, inside in pieces(data[bounds[i] : bounds[i + 1]], one, _BREAKS):
                total += np.bincount(ngram_buckets(piece, inside)[1], minlength=1 << BUCKET_BITS).astype(np.int32)
            met = np.flatnonzero(total).astype(np.int32)
            n = total[met]
            buckets.append(met)
            counts.append(n)
        return pa.RecordBatch.from_arrays(
            [batch.column("lang"), batch.column("part"), pa.array(buckets, pa.list_(pa.int32())),
             pa.array(counts, pa.list_(pa.int32()))], ["lang", "part", "buckets", "counts"])

    return map_batches(sample.select("lang", part.alias("part"), "text"), count,
                       "lang string, part int, buckets array<int>, counts array<int>")


def train(sample: list, epochs: int = EPOCHS, rate: float = 40.0, batch: int = 32, seed: int = 7) -> LanguageModel:
    """Fit a model to rows of ``labelled_sample``. Without rows, or with one language, it knows only these."""
    languages = sorted({row["lang"] for row in sample})
    size = 1 << BUCKET_BITS
    if not languages:
        return LanguageModel([], np.zeros((size, 1), np.float32), np.zeros(0), 1.0, 0.0, 0.0)
    rows = [
        (languages.index(r["lang"]), r["part"], np.asarray(r["buckets"], np.int64), np.asarray(r["counts"], np.float32))
        for r in sample
        if len(r["buckets"])
    ]
    # The order must not depend on the order in which tasks end.
    rows.sort(key=lambda r: (r[0], r[1], len(r[2]), float(r[3].sum()), r[2][:8].tolist()))
    fitted = [r for r in rows if r[1] != 0] or rows
    held = [r for r in rows if r[1] == 0] or rows
    random = np.random.default_rng(seed)
    embeddings = random.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32)
    softmax = random.normal(0, 0.1, (DIMENSIONS, len(languages))).astype(np.float32)
    bias = np.zeros(len(languages), np.float32)
    seen = np.zeros(size, bool)
    # Rare languages weigh as much as frequent ones.
    weight = 1.0 / np.maximum(np.bincount([r[0] for r in fitted], minlength=len(languages)), 1)
    weight = weight / weight.max() if len(fitted) else weight
    steps = epochs * -(-len(fitted) // batch)
    step = 0
    for epoch in range(epochs):
        order = random.permutation(len(fitted))
        for start in range(0, len(order), batch):
            chosen = [fitted[i] for i in order[start : start + batch]]
            ids = np.concatenate([r[2] for r in chosen])
            share = np.concatenate([r[3] / r[3].sum() for r in chosen])
            ends = np.cumsum([0] + [len(r[2]) for r in chosen])
            mean = np.add.reduceat(embeddings[ids] * share[:, None], ends[:-1], axis=0)
            error = _probabilities(mean @ softmax + bias, 1.0)
            truth = np.array([r[0] for r in chosen])
            error[np.arange(len(chosen)), truth] -= 1.0
            error *= weight[truth][:, None] / len(chosen)
            now = np.float32(rate * (1.0 - step / steps))
            back = np.repeat((error @ softmax.T), np.diff(ends), axis=0) * share[:, None]
            softmax -= np.float32(0.05) * now * (mean.T @ error).astype(np.float32)
            bias -= np.float32(0.01) * now * error.sum(axis=0).astype(np.float32)
            np.add.at(embeddings, ids, -now * back.astype(np.float32))
            seen[ids] = True
            step += 1
    table = np.concatenate([embeddings @ softmax, seen[:, None]], axis=1).astype(np.float32)

    def logits(rows: list) -> tuple[np.ndarray, np.ndarray]:
        sums = np.array([(table[r[2]] * r[3][:, None]).sum(axis=0) / r[3].sum() for r in rows])
        return sums[:, :-1] + bias, sums[:, -1]

    found, known = logits(held)
    truth = np.array([r[0] for r in held])
    tried = np.geomspace(0.05, 20, 60)
    losses = [-np.log(_probabilities(found, t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in tried]
    temperature = float(tried[int(np.argmin(losses))])
    scores = _probabilities(found, temperature).max(axis=1)
    right = found.argmax(axis=1) == truth
    right = right if right.any() else np.ones(len(truth), bool)
    # Both bounds lie clearly below what the calibration texts would allow: a wrong rejection
    # loses a document for good.
    least_score = min(0.5, 0.5 * (1 / len(languages) + float(np.quantile(scores[right], REJECTED_SHARE))))
    least_known = 0.6 * float(np.quantile(known[right], REJECTED_SHARE))
    return LanguageModel(languages, table, bias, temperature, least_score, least_known)


def fit(docs: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE) -> LanguageModel:
    """A model from the labelled rows of ``docs (text, lang)``; the bounded sample goes to the driver."""
    return train(labelled_sample(docs, texts_per_language).collect())


def judge(model: LanguageModel, texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, ...]:
    """Language, score, share of known n-grams and acceptance of each text; ``letters``: which have any."""
    n = len(texts)
    if not model.languages:
        return np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n), np.zeros(n, bool)
    sums, counts = text_logits(*text_bytes(texts), model.table)
    means = sums / np.maximum(counts, 1)[:, None]
    chances = _probabilities(means[:, :-1] + model.bias, model.temperature)
    best = chances.argmax(axis=1)
    score = np.where(letters, np.round(np.clip(chances[np.arange(n), best], 0, 1), 6), 0.0)
    known = np.where(letters, np.round(means[:, -1], 6), 0.0)
    accepted = letters & (score >= model.least_score) & (known >= model.least_known)
    return np.where(letters, np.array(model.languages, object)[best], UNKNOWN), score, known, accepted


def _has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def _flags(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False), bool)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score, known_share, accepted)``, one row for each row of ``docs``.

    A null text, a text without a letter, or a model without languages gives ``und``, score
    0, not accepted. Texts of any length are read whole. Equal texts get equal results.
    """

    def predict(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, score, known, accepted = judge(model, batch.column("text"), _flags(batch.column("letters")))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(known), pa.array(accepted)],
            ["doc_id", "lang_pred", "score", "known_share", "accepted"])

    texts = id_and_text(docs.withColumn("letters", _has_letter()), "text", "letters")
    kind = dict(docs.dtypes)["doc_id"]
    return map_batches(
        texts, predict, f"doc_id {kind}, lang_pred string, score double, known_share double, accepted boolean")


def keep_identified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` whose text is accepted, with all their columns.

    All columns pass through the task, so nothing is joined.
    """
    flag = free_name(docs, "accepted")

    def mark(batch: pa.RecordBatch) -> pa.RecordBatch:
        accepted = judge(model, batch.column("text"), _flags(batch.columns[-1]))[3]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(accepted)], schema=batch.schema)

    marked = docs.withColumn(flag, _has_letter())
    return marked.mapInArrow(lambda batches: (mark(b) for b in batches), marked.schema).where(flag).drop(flag)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text is a multiple of 5."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0, F.lit(False))
