"""Token counts by a Viterbi pass that keeps scores and counts, but no pieces.

The vocabulary of a tokenizer file is read as a unigram model: the segmentation with the best
sum of scores counts. An Aho-Corasick automaton lists the pieces that end at each character;
for each position the pass carries the best score and the number of pieces that reach it. Of
segmentations with equal scores the one whose last piece is longest is taken, the rule of the
public unigram implementations. A character that is no piece costs ten less than the worst
piece, and counts as its UTF-8 bytes.
"""

import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from quillmark.llm.arrow_text import id_and_text

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# The character that stands for a blank, and what an unknown character costs beyond the worst piece.
BLANK = "▁"
UNKNOWN_COST = 10.0
# Units of text that a task remembers.
CACHE = 400_000


@dataclass
class Vocabulary:
    """Pieces with their scores."""

    pieces: dict[str, float]

    @property
    def unknown(self) -> float:
        return min(self.pieces.values(), default=0.0) - UNKNOWN_COST


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces of a tokenizer file, without its control, unknown and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(len(model)) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return Vocabulary({model.id_to_piece(i): model.get_score(i) for i in plain})


def normal_form(text: str) -> str:
    """Blanks as visible characters, and one in front."""
    return BLANK + text.replace(" ", BLANK) if text else ""


class PieceCounter:
    """Counts the pieces of texts under a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        # An automaton without words cannot be asked.
        self.matches = self.automaton.iter if vocabulary.pieces else lambda unit: ()
        self.unknown = vocabulary.unknown
        alphabet = {c for piece in vocabulary.pieces for c in piece}
        inside = any(BLANK in piece.lstrip(BLANK) for piece in vocabulary.pieces)
        # No piece goes on beyond a line feed or, but at its start, a blank, so units between them stand alone.
        if "\n" in alphabet or inside:
            self.units = re.compile(r"(?s).+")
        else:
            self.units = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n+")
        self.known: dict[str, int] = {}

    def unit(self, unit: str) -> int:
        """Pieces of the best segmentation of one unit."""
        best, count = [0.0], [0]
        at, top, pieces, single = 0, None, 0, False
        for end, (length, score) in self.matches(unit):
            while at < end:
                top, pieces = self._close(unit, at, top, pieces, single, best, count)
                at, single = at + 1, False
            start = end + 1 - length
            value = best[start] + score
            # The longest piece comes first, so an equal value changes nothing.
            if top is None or value > top:
                top, pieces = value, count[start] + 1
            single = single or length == 1
        while at < len(unit):
            top, pieces = self._close(unit, at, top, pieces, single, best, count)
            at, single = at + 1, False
        return count[-1]

    def _close(self, unit, at, top, pieces, single, best, count):
        """Finish a position: without a piece of its own, the character may also be unknown."""
        if not single:
            value = best[at] + self.unknown
            if top is None or value > top:
                top, pieces = value, count[at] + len(unit[at].encode())
        best.append(top)
        count.append(pieces)
        return None, 0

    def __call__(self, text: str) -> int:
        units = Counter(self.units.findall(normal_form(text)))
        known, total = self.known, 0
        for unit, n in units.items():
            pieces = known.get(unit)
            if pieces is None:
                pieces = self.unit(unit)
                if len(known) >= CACHE:
                    known.clear()
                if len(unit) < 64:
                    known[unit] = pieces
            total += n * pieces
        return total


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(doc_id, n_tokens)``, one row for each row of ``docs``; 0 for a null or empty text. Texts are counted whole.

    The vocabulary is as large as the tokenizer file, whatever the input, and goes with the task.
    """

    def run(batches):
        counter = PieceCounter(vocabulary)
        for batch in batches:
            counts = [counter(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return id_and_text(docs).mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens bigint")
