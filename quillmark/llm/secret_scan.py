"""Secrets in whole texts: fixed formats, and strings that zstandard finds new where a secret is expected.

The fixed formats give the base spans. Beyond them, tokens that stand behind a sensitive word
are candidates. A candidate's novelty is the number of bytes by which it lengthens the
compressed text around it, for a compressor that already holds that text, without the
candidate's own copies, and a dictionary of usual identifiers. Names and placeholders cost few
bytes; a random key costs nearly its own length and is reported. A long key of few symbols costs less,
because its symbols get short codes; so what it costs is also held against random strings of
the same symbols. A token with hardly a digit may be a word or a path in any language, which the
compressor does not know: it is reported if its letters do not follow each other as in the text
around it and in the identifiers.
"""

import bisect
import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.arrow_text import groups, id_and_text, map_batches, text_bytes

# The base formats, in their order.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "novel")

SENSITIVE = ("key", "secret", "token", "passw", "pwd", "auth", "credential", "private", "bearer", "signature")
CANDIDATE_BYTES, REACH, CONTEXT = 16, 64, 512
# Marginal compressed bytes for each byte of a candidate from which on it is new.
LEAST_NOVELTY = 0.85
# Shuffled copies of a candidate of which the cheapest is the measure, and bits per symbol from which on it is one.
COPIES, LEAST_ENTROPY = 5, 2.5
# Share of a token's pairs of letters that are usual ones, from which on it reads as words.
LEAST_WORDLIKE = 0.6
# What code calls things, and what stands where a secret would be.
IDENTIFIERS = (
    "access account admin apikey application auth authorization backend base64 bearer build bucket changeme client "
    "cluster config connection content context credential database debug default deploy description development "
    "document dummy email encoding endpoint environment example export fake fixture function gateway getenv github "
    "header hostname identifier image import insert_here instance integration interface internal localhost manager "
    "master message metadata model module mysecret namespace network number object option output package parameter "
    "password path pipeline placeholder platform policy postgres private production profile project property provider "
    "public redacted region release remote replace_me repository request resource response return sandbox sample "
    "schema secret security server service session settings signature socket source staging storage string super "
    "system template testing timeout token undefined update upload username value variable version virtual webhook "
    "workspace xxxxxxxxxxxxxxxx your_api_key_here your-secret-token 0123456789 1234567890 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 11111111"
)

_ASSIGN = re.compile(ASSIGN.encode(), re.I)
_ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"api")
_ACCESS = re.compile(ACCESS.encode())
_SENSITIVE = re.compile("|".join(SENSITIVE).encode(), re.I)
_CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=.-]{%d,}" % CANDIDATE_BYTES)
_LETTERS, _WORDS = re.compile(rb"[A-Za-z]+"), re.compile(rb"[A-Z]?[a-z]+|[A-Z]+")
_HEX = np.zeros(256, bool)
_HEX[[*range(48, 58), *range(97, 103)]] = True


def hex_runs(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text number, start, end)`` of the longest runs of lower-case hexadecimal digits that are long enough."""
    found = []
    for first, last in groups(bounds):
        start, stop = int(bounds[first]), int(bounds[last])
        flags = _HEX[data[start:stop]]
        edges = np.concatenate([[0], np.flatnonzero(flags[1:] != flags[:-1]) + 1, [len(flags)]])
        edges = np.union1d(edges, bounds[first : last + 1] - start)
        long = np.flatnonzero(np.diff(edges) >= LEAST_HEX)
        long = long[flags[edges[long]]]
        found.append(np.stack([edges[long], edges[long + 1]]) + start)
    starts, ends = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return np.searchsorted(bounds, starts, "right") - 1, starts, ends


def _core(token: bytes) -> bytes:
    """A token without the signs at its ends, which may differ from copy to copy."""
    return token.strip(b"+/_=.-") or token


def _letter_pairs(text: bytes, words: re.Pattern[bytes]) -> set[bytes]:
    return {word[i : i + 2] for word in words.findall(text.lower()) for i in range(len(word) - 1)}


def _entropy(token: bytes) -> float:
    """Bits per symbol of a token."""
    share = np.bincount(np.frombuffer(token, np.uint8)) / len(token)
    share = share[share > 0]
    return float(-(share * np.log2(share)).sum())


class Novelty:
    """Marginal compressed size of a candidate, given the text around it.

    It is a share of the candidate's length, or, if that is more, of the size of the cheapest of
    some shuffled copies, which no order of the symbols makes cheap.
    """

    def __init__(self, identifiers: str = IDENTIFIERS):
        self.identifiers = identifiers.encode()
        self.pairs = _letter_pairs(self.identifiers, _LETTERS) - _letter_pairs(b"abcdefghijklmnopqrstuvwxyz", _LETTERS)

    def _around(self, text: bytes, start: int, end: int) -> tuple[bytes, bytes]:
        # A key that stands there twice is as new at both places, also where the context cuts its copy.
        own, wide = _core(text[start:end]), CONTEXT + end - start
        blank = b"\n" * len(own)
        return (text[max(start - wide, 0) : start].replace(own, blank)[-CONTEXT:],
                text[end : end + wide].replace(own, blank)[:CONTEXT])

    def reads_as_words(self, text: bytes, start: int, end: int) -> bool:
        """Whether a token with few digits or letters consists of pairs of letters that are usual around it."""
        token = text[start:end]
        letters = _LETTERS.findall(token)
        if sum(map(len, letters)) >= 2 and sum(48 <= c < 58 for c in token) >= 2:
            return False
        before, after = self._around(text, start, end)
        usual = self.pairs | _letter_pairs(before, _LETTERS) | _letter_pairs(after, _LETTERS)
        read = sum(word[i : i + 2].lower() in usual for word in _WORDS.findall(token) for i in range(len(word) - 1))
        return read >= LEAST_WORDLIKE * max(sum(len(run) - 1 for run in letters), 1)

    def __call__(self, text: bytes, start: int, end: int) -> float:
        before, after = self._around(text, start, end)
        known = zstandard.ZstdCompressionDict(
            self.identifiers + b"\n" + after + b"\n" + before, dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        compressor = zstandard.ZstdCompressor(
            level=9, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False
        )
        lead = before[-32:]
        token, alone = text[start:end], len(compressor.compress(lead))
        more = len(compressor.compress(lead + token)) - alone
        usual = len(token)
        # Copies of a token of one or two symbols are like the token itself.
        if more < LEAST_NOVELTY * usual and _entropy(token) >= LEAST_ENTROPY:
            rng = np.random.default_rng(int.from_bytes(hashlib.sha256(token).digest()[:8]))
            copies = (rng.permutation(np.frombuffer(token, np.uint8)).tobytes() for _ in range(COPIES))
            usual = min(usual, *(len(compressor.compress(lead + copy)) - alone for copy in copies))
        return more / max(usual, 1)


def _joined(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of what the spans cover together, in order."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end in sorted(spans):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def _novel(text: bytes, low: bytes, taken: list[tuple[int, int]], novelty: Novelty) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    known: list[tuple[int, int]] = []
    starts, ends = _joined(taken)
    reached = 0
    for word in _SENSITIVE.finditer(low):
        limit = min(word.end() + REACH, len(text))
        at = max(word.end(), reached)
        while at < limit and (match := _CANDIDATE.search(text, at, limit + CANDIDATE_BYTES - 1)):
            # The whole token, also beyond the reach.
            start, end = match.start(), _CANDIDATE.match(text, match.start()).end()
            at = reached = end
            place = bisect.bisect_right(ends, start)
            if place == len(starts) or starts[place] >= end:
                new = novelty(text, start, end) >= LEAST_NOVELTY and not novelty.reads_as_words(text, start, end)
                (spans if new else known).append((start, end))
    if not spans or not known:
        return spans
    # A longer token that holds a new one is known by it only. One search finds the new ones in a token.
    cores = ahocorasick.Automaton()
    for a, b in spans:
        cores.add_word(_core(text[a:b]).decode("latin-1"), True)
    cores.make_automaton()
    return spans + [(a, b) for a, b in known if next(cores.iter(text[a:b].decode("latin-1")), None)]


def find_spans(data: np.ndarray, bounds: np.ndarray, novelty: Novelty) -> list[list[tuple[int, int, int]]]:
    """``(start, kind number, end)`` in bytes of all spans of each text, in order."""
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(bounds) - 1)]
    for row, start, end in zip(*(x.tolist() for x in hex_runs(data, bounds))):
        spans[row].append((start - int(bounds[row]), 2, end - int(bounds[row])))
    for row, own in enumerate(spans):
        text = data[bounds[row] : bounds[row + 1]].tobytes()
        low = text.lower()
        if any(word in low for word in _ASSIGN_WORDS):
            own += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
        if b"AKIA" in text:
            own += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
        if any(word.encode() in low for word in SENSITIVE):
            own += [(a, 3, b) for a, b in _novel(text, low, [(s, e) for s, _, e in own], novelty)]
        own.sort()
    return spans


def _code_points(text: np.ndarray, own: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans in bytes as spans in code points."""
    before = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
    return [(int(before[start]), kind, int(before[end])) for start, kind, end in own]


def _named(own: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in own)


def scan(docs: DataFrame, identifiers: str = IDENTIFIERS) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row for each row of ``docs``.

    ``spans`` lists ``kind:start:end`` of all spans by start and then kind, in code points with
    the end excluded; ``base_sha256`` is the digest of the same list without the kind that
    novelty adds. A null or empty text has no spans. Texts are scanned whole.
    """
    novelty = Novelty(identifiers)

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = text_bytes(batch.column("text"))
        counts = np.zeros((3, batch.num_rows), np.int64)
        none = hashlib.sha256(b"").hexdigest()
        digests, listed = [none] * batch.num_rows, [""] * batch.num_rows
        for row, own in enumerate(find_spans(data, bounds, novelty)):
            if own:
                own = _code_points(data[bounds[row] : bounds[row + 1]], own)
                base = [span for span in own if span[1] < 3]
                counts[:, row] = np.bincount([kind for _, kind, _ in base], minlength=3)
                digests[row], listed[row] = hashlib.sha256(_named(base).encode()).hexdigest(), _named(own)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c) for c in counts), pa.array(digests), pa.array(listed)],
            ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return map_batches(
        id_and_text(docs), look, f"doc_id {dict(docs.dtypes)['doc_id']}, n_assign bigint, n_access bigint, "
        "n_hex bigint, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[secret]", identifiers: str = IDENTIFIERS) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; ``n_chars``, if there, is counted anew where a text changes.

    No row goes. Null texts stay null; spans that overlap are replaced together.
    """
    novelty = Novelty(identifiers)
    at = docs.columns.index("text")
    schema = docs.schema

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, bounds = text_bytes(batch.column(at))
        found = find_spans(data, bounds, novelty)
        if not any(found):
            return batch
        texts = batch.column(at).to_pylist()
        for row, own in enumerate(found):
            if own:
                text, parts, reached = data[bounds[row] : bounds[row + 1]].tobytes(), [], 0
                for start, _, end in own:
                    if start >= reached:
                        parts += [text[reached:start], mark.encode()]
                    reached = max(reached, end)
                texts[row] = b"".join([*parts, text[reached:]]).decode()
        columns = list(batch.columns)
        columns[at] = pa.array(texts, batch.column(at).type)
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    cleaned = docs.mapInArrow(lambda batches: (clean(b) for b in batches), schema)
    if "n_chars" in docs.columns:
        changed = F.col("text").contains(mark)
        length = F.length("text").cast(schema["n_chars"].dataType)
        cleaned = cleaned.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return cleaned
