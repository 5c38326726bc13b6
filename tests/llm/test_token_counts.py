import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from quillmark.llm.token_counts import VOCABULARY, PieceCounter, Vocabulary, count_tokens, normal_form, read_vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return read_vocabulary()


@pytest.fixture(scope="module")
def reference():
    """The public unigram implementation over the same file."""
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(len(model))]
    return Tokenizer(Unigram(pieces, unk_id=0, byte_fallback=True))


@pytest.fixture(scope="module")
def counter(vocabulary):
    return PieceCounter(vocabulary)


def wanted(reference, text):
    return len(reference.encode(normal_form(text), add_special_tokens=False).ids)


@given(st.text(st.sampled_from("abcdethin  .,\n\té漢🙂▁\x00Ж"), max_size=40))
@settings(max_examples=500, deadline=None)
def test_equal_to_the_public_implementation(reference, counter, text):
    assert counter(text) == wanted(reference, text)


@given(st.text(max_size=30).filter(lambda t: "<" not in t and not any(0xD800 <= ord(c) < 0xE000 for c in t)))
@settings(max_examples=300, deadline=None)
def test_equal_on_any_text(reference, counter, text):
    assert counter(text) == wanted(reference, text)


@given(st.lists(st.tuples(st.text("abc▁", min_size=1, max_size=4), st.integers(-4, -1)), max_size=14),
       st.text("abc \nx", max_size=14))
@settings(max_examples=400, deadline=None)
def test_ties_and_other_vocabularies(pieces, text):
    """Equal scores are common here; blanks may stand inside pieces."""
    pieces = dict(pieces)
    model = Unigram([("<unk>", 0.0), *((p, float(s)) for p, s in pieces.items())], unk_id=0, byte_fallback=False)
    known = Vocabulary({p: float(s) for p, s in pieces.items()})
    # Without byte pieces the public one makes a run of unknown characters one token.
    best = Tokenizer(model).encode(normal_form(text), add_special_tokens=False)
    tokens = sum(len(normal_form(text)[a:b].encode()) if i == 0 else 1 for i, (a, b) in zip(best.ids, best.offsets))
    if min([0.0, *known.pieces.values()]) == min(known.pieces.values(), default=0.0):
        assert PieceCounter(known)(text) == tokens


def test_whole_corpus(spark, tiny_dir, vocabulary, reference):
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs, vocabulary).collect()}
    assert got == {r["doc_id"]: wanted(reference, r["text"]) for r in docs.collect()}


def test_awkward_rows(awkward, nothing, vocabulary):
    rows = count_tokens(awkward, vocabulary).collect()
    assert len(rows) == 10
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (2, 3)} == {0}
    assert len({r["n_tokens"] for r in rows if r["doc_id"] in (5, 8)}) == 1
    assert count_tokens(nothing, vocabulary).count() == 0
