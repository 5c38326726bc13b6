"""Benchmark decontamination by multi-pattern search after Wu and Manber.

The windows of the benchmark items are the patterns. Texts and patterns are brought to one
form first: lower-cased words with one blank in front of, between and behind them, so that an
occurrence of a pattern's bytes is an occurrence of its words. Patterns of similar length
share a table of block shifts: the last block of the current window tells how far the window
may move without passing an occurrence. Where it may not move, the patterns that end in that
block are looked up, and compared byte by byte. NumPy moves thousands of windows at a time.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import free_name, groups, text_bytes
from quillmark.sources.staging import restage, stage

WINDOW_WORDS = 10
# Bytes of windows that are searched for at a time; a larger benchmark is searched for in several rounds.
BLOCK_BYTES = 32 << 20
TABLE_BITS = 20
# Windows that move on their own start this far apart.
STRIDE = 256
# Pattern lengths from which on a class of patterns uses blocks of so many bytes.
CLASSES = ((0, 3), (10, 5), (24, 8))

_SQL_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_MARK = 1
_FOLD = np.full(256, 32, np.uint8)
_FOLD[48:58] = np.arange(48, 58)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def normal_form(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each as a mark, a blank, and its words with a blank behind each; starts of the marks."""
    lengths = np.diff(bounds)
    n = len(lengths)
    padded = np.full(len(data) + 3 * n, 32, np.uint8)
    padded[np.arange(len(data)) + 3 * np.repeat(np.arange(n), lengths) + 2] = _FOLD[data]
    padded[bounds[:-1] + 3 * np.arange(n)] = _MARK
    kept = np.ones(len(padded), bool)
    kept[1:] = (padded[1:] != 32) | (padded[:-1] != 32)
    form = padded[kept]
    return form, np.flatnonzero(form == _MARK)


def words_of(text: str | None) -> list[bytes]:
    """The words of one text."""
    return _FOLD[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()


def _eights(form: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number; ``form`` ends in eight spare bytes."""
    return np.ndarray((len(form) - 7,), "<u8", form, strides=(1,))


def _slots(blocks: np.ndarray) -> np.ndarray:
    return (blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TABLE_BITS)


@dataclass
class PatternClass:
    """Patterns of similar length: the shift table, and the patterns by the block that ends their shortest length."""

    shortest: int
    block: int
    shift: np.ndarray
    suffixes: np.ndarray
    ids: np.ndarray


@dataclass
class Patterns:
    classes: list[PatternClass]
    # Each pattern as 8-byte numbers in a row; the last one is masked.
    numbers: np.ndarray
    masks: np.ndarray
    starts: np.ndarray
    n_words: np.ndarray
    # Items that have the pattern, in a row.
    items: np.ndarray
    item_starts: np.ndarray
    names: list[str]


def build_patterns(items: list[tuple[str, str | None]], window: int = WINDOW_WORDS) -> Patterns:
    """Patterns of ``(item_id, text)``. An item without words has none; equal windows are one pattern."""
    names = sorted({name for name, _ in items})
    number = {name: i for i, name in enumerate(names)}
    found: dict[bytes, set[int]] = {}
    for name, text in items:
        words = words_of(text)
        for i in range(max(len(words) - window + 1, 1) if words else 0):
            found.setdefault(b" " + b" ".join(words[i : i + window]) + b" ", set()).add(number[name])
    texts = sorted(found)
    lengths = np.array([len(t) for t in texts], np.int64)
    counts = -(-lengths // 8)
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    numbers = np.frombuffer(b"".join(t.ljust(8 * c, b"\0") for t, c in zip(texts, counts)), "<u8")
    masks = np.full(len(numbers), 2**64 - 1, np.uint64)
    for end, length in zip(starts[1:], lengths):
        if length % 8:
            masks[end - 1] = np.uint64((1 << (8 * int(length % 8))) - 1)
    classes = []
    limits = [low for low, _ in CLASSES[1:]] + [1 << 62]
    for (low, block), high in zip(CLASSES, limits):
        ids = np.flatnonzero((lengths >= low) & (lengths < high))
        if len(ids):
            classes.append(_pattern_class([texts[i] for i in ids], ids, block))
    owners = [sorted(found[t]) for t in texts]
    return Patterns(
        classes, numbers, masks, starts, np.array([t.count(b" ") - 1 for t in texts], np.int64),
        np.array([i for o in owners for i in o], np.int64),
        np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64), names,
    )


def _pattern_class(texts: list[bytes], ids: np.ndarray, block: int) -> PatternClass:
    shortest = min(map(len, texts))
    shift = np.full(1 << TABLE_BITS, shortest - block + 1, np.int32)
    heads = np.frombuffer(b"".join(t[:shortest] for t in texts) + bytes(8), np.uint8)
    mask = np.uint64(2**64 - 1 if block == 8 else (1 << (8 * block)) - 1)
    view = _eights(heads)
    at = np.arange(len(texts)) * shortest
    for i in range(shortest - block + 1):
        np.minimum.at(shift, _slots(view[at + i] & mask), shortest - block - i)
    suffixes = view[at + shortest - block] & mask
    order = np.argsort(suffixes, kind="stable")
    return PatternClass(shortest, block, shift, suffixes[order], ids[order])


def _candidates(view: np.ndarray, size: int, group: PatternClass) -> tuple[np.ndarray, np.ndarray]:
    """``(position, pattern)`` where the last block of the shortest length agrees."""
    mask = np.uint64(2**64 - 1 if group.block == 8 else (1 << (8 * group.block)) - 1)
    last = size - group.shortest
    back = group.shortest - group.block
    at = np.arange(0, last + 1, STRIDE)
    ends = np.minimum(at + STRIDE, last + 1)
    places, blocks = [], []
    while len(at):
        block = view[at + back] & mask
        shift = group.shift[_slots(block)]
        stopped = shift == 0
        places.append(at[stopped])
        blocks.append(block[stopped])
        at = at + np.maximum(shift, 1)
        going = at < ends
        at, ends = at[going], ends[going]
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, block = np.concatenate(places), np.concatenate(blocks)
    first = np.searchsorted(group.suffixes, block, "left")
    n = np.searchsorted(group.suffixes, block, "right") - first
    pattern = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    return np.repeat(place, n), group.ids[pattern]


def occurrences(form: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """``(position, pattern)`` of every occurrence in a text in normal form."""
    spare = np.concatenate([form, np.zeros(8, np.uint8)])
    view = _eights(spare)
    places, found = [], []
    for group in patterns.classes:
        place, pattern = _candidates(view, len(form), group)
        step = 0
        alive = np.ones(len(place), bool)
        left = np.arange(len(place))
        while len(left):  # compare eight bytes at a time
            number = patterns.starts[pattern[left]] + step
            at = np.minimum(place[left] + 8 * step, len(view) - 1)
            same = (view[at] & patterns.masks[number]) == patterns.numbers[number]
            alive[left[~same]] = False
            step += 1
            left = left[same]
            left = left[patterns.starts[pattern[left]] + step < patterns.starts[pattern[left] + 1]]
        places.append(place[alive])
        found.append(pattern[alive])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(found)


def search(data: np.ndarray, bounds: np.ndarray, patterns: Patterns) -> tuple[np.ndarray, list, list]:
    """Words, hit words as a list of flags (None: none), and names of the items found, for each text."""
    n = len(bounds) - 1
    n_words = np.zeros(n, np.int64)
    hits: list = [None] * n
    items: list = [[] for _ in range(n)]
    for first, last in groups(bounds):
        part = data[bounds[first] : bounds[last]]
        form, marks = normal_form(part, bounds[first : last + 1] - bounds[first])
        begins = np.zeros(len(form) + 1, bool)
        begins[1:-1] = (form[:-1] == 32) & (form[1:] != 32) & (form[1:] != _MARK)
        before = np.cumsum(begins[:-1]) - begins[:-1]  # words in front of a position
        ends = np.append(before[marks], np.count_nonzero(begins))
        n_words[first:last] = np.diff(ends)
        place, pattern = occurrences(form, patterns)
        if not len(place):
            continue
        opened = before[place + 1]
        change = np.zeros(int(ends[-1]) + 1, np.int64)
        np.add.at(change, opened, 1)
        np.add.at(change, opened + patterns.n_words[pattern], -1)
        hit = np.cumsum(change)[:-1] > 0
        text = np.searchsorted(marks, place, "right") - 1
        n_items = patterns.item_starts[pattern + 1] - patterns.item_starts[pattern]
        item = patterns.items[
            np.repeat(patterns.item_starts[pattern] - np.cumsum(n_items) + n_items, n_items) + np.arange(n_items.sum())
        ]
        pairs = np.unique(np.repeat(text, n_items) * len(patterns.names) + item)
        for pair in pairs.tolist():
            items[first + pair // len(patterns.names)].append(patterns.names[pair % len(patterns.names)])
        for one in np.unique(text).tolist():
            hits[first + one] = hit[ends[one] : ends[one + 1]]
    return n_words, hits, items


def windows_of(benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``(name, passage)``: the different windows of each item, as words with one blank between."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"),
        F.regexp_extract_all(lower, F.lit(_SQL_WORD), F.lit(0)).alias("words"),
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - F.lit(window - 1), F.lit(1)))
    passages = F.transform(starts, lambda at: F.array_join(F.slice("words", at, window), " "))
    return words.select("name", F.explode(F.array_distinct(passages)).alias("passage")).distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS, keep_text: bool = True,
                  block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with words, hit words and found items, and the names of these columns.

    The columns are ``n_words``; ``hits``, a bit for each word from the first on (null: none
    hit); and ``items``, the ids as strings, sorted. They get other names if ``docs`` has
    such columns. Null texts, and texts or items without words, have no words and no hits.
    Items with one id are one item; a null id is the empty string. Texts are searched whole.

    The windows of the benchmark are a table, dealt by hash into blocks of about
    ``block_bytes``; the driver and the tasks hold one block at a time. No row is shuffled: each
    block is searched for in one pass over the texts, and all passes but the last are written.
    """
    names = {c: free_name(docs, c) for c in ("n_words", "hits", "items")}
    found = docs.select(
        "*", F.lit(0).cast("bigint").alias(names["n_words"]), F.lit(None).cast("binary").alias(names["hits"]),
        F.array().cast("array<string>").alias(names["items"]),
    )
    windows = stage(windows_of(benchmark, window), "benchmark-windows")
    total = windows.agg(F.sum((F.octet_length("passage") + F.octet_length("name")).cast("bigint"))).first()[0] or 0
    n_blocks = -(-total // block_bytes) or 1
    # By both columns, so that a passage of very many items is dealt over the blocks, too.
    block = F.pmod(F.xxhash64("passage", "name"), F.lit(n_blocks))
    folder = None
    for i in range(n_blocks):
        rows = windows.where(block == i).collect()
        patterns = build_patterns([(r["name"], r["passage"]) for r in rows], window)
        last = i == n_blocks - 1
        found = _looked_for(found, docs.columns.index("text"), patterns, last and not keep_text)
        if not last:
            found, folder = restage(found, "passages-so-far", folder)
    return found, names


def _looked_for(found: DataFrame, at: int, patterns: Patterns, drop: bool) -> DataFrame:
    """``found`` with the hits of these patterns added to the last three columns; column ``at`` is the text, to ``drop`` or keep."""
    schema = found.drop("text").schema if drop else found.schema

    def look(batches):
        for batch in batches:
            n_words, flags, items = search(*text_bytes(batch.column(at)), patterns)
            old_hits, old_items = batch.columns[-2].to_pylist(), batch.columns[-1].to_pylist()
            for row, flag in enumerate(flags):
                if flag is not None:
                    bits = np.packbits(flag)
                    if old_hits[row] is not None:
                        bits = bits | np.frombuffer(old_hits[row], np.uint8)
                    old_hits[row] = bits.tobytes()
                    old_items[row] = sorted({*old_items[row], *items[row]})
            made = [*batch.columns[:-3], pa.array(n_words), pa.array(old_hits, pa.binary()),
                    pa.array(old_items, pa.list_(pa.string()))]
            labels = list(batch.schema.names)
            if drop:
                del made[at], labels[at]
            yield pa.RecordBatch.from_arrays(made, labels)

    return found.mapInArrow(look, schema)


def _bits(hits: Column) -> Column:
    """Number of bits that are set."""
    digits = F.hex(hits)
    ones = sum(
        F.length(digits) - F.length(F.translate(digits, group, "")) if weight else F.lit(0)
        for group, weight in (("1248", 1), ("3569AC", 2), ("7BDE", 3), ("F", 4))
        for _ in range(weight)
    )
    return F.coalesce(ones, F.lit(0)).cast("bigint")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, one row for each row of ``docs``."""
    found, names = find_passages(docs.select("doc_id", "text"), benchmark, window, keep_text=False)
    n_hit = _bits(F.col(names["hits"]))
    return found.select(
        "doc_id", names["n_words"], n_hit.alias("n_hit"),
        F.size(names["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", names["items"]), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, with all their columns."""
    found, names = find_passages(docs, benchmark, window)
    return found.where(F.col(names["hits"]).isNull()).select(*docs.columns)


_SQL_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  coalesce(regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}'), []) AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, coalesce(regexp_extract_all({_SQL_LOWER}, '{_SQL_WORD}'), []) AS w
  FROM benchmark),
p AS (SELECT DISTINCT item, least(len(w), {WINDOW_WORDS}) AS k,
  array_to_string(w[s : s + least(len(w), {WINDOW_WORDS}) - 1], ' ') AS passage
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {WINDOW_WORDS} + 1, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM p),
q AS (SELECT r, k, s, array_to_string(w[s : s + k - 1], ' ') AS passage
  FROM (SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS s FROM d, ks WHERE len(w) >= k)),
o AS (SELECT q.r, q.s, p.k, p.item FROM q JOIN p USING (k, passage)),
h AS (SELECT r, count(DISTINCT i)::BIGINT AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS i FROM o) GROUP BY r),
n AS (SELECT r, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN n USING (r)
"""
