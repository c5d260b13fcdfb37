"""Token counts and pieces against the libraries."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

from wayside.llm import pieces, prefix_tokens

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MIXED = st.text(st.sampled_from(list("abc it's we'll   \n\t\r.,!?_-0129é²½ßñ一あ🙂　\x1c\x85▁")) | st.characters(codec="utf-8"), max_size=40)


@pytest.fixture(scope="module")
def counter():
    return prefix_tokens.PrefixCounter(open(BYTES, "rb").read())


@pytest.fixture(scope="module")
def codec():
    return pieces.PieceCodec(open(PIECES, "rb").read())


TOKENIZER = Tokenizer.from_file(BYTES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PIECES)


def count(text):
    return len(TOKENIZER.encode(text, add_special_tokens=False))


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_every_prefix_has_the_librarys_count(counter, text):
    assert counter.prefix_counts(text).tolist() == [count(text[:i]) for i in range(len(text) + 1)]
    assert counter.measure(text)[0] == count(text)


def test_special_strings_inside_a_text(counter):
    for text in ["a<|endoftext|>b", "<|endoftext|>", "!!<|endoftext|><|endof", "it's  <|endoftext|>'ll"]:
        assert counter.prefix_counts(text).tolist() == [count(text[:i]) for i in range(len(text) + 1)]


@pytest.mark.parametrize("limit", [0, 1, 3, 10])
def test_longest_fitting_prefix(counter, limit):
    for text in ["hello world, this is it", "a  b\n\nc", "unbelievable", "x" * 50]:
        longest = max(i for i in range(len(text) + 1) if count(text[:i]) <= limit)
        total, fits = counter.measure(text, limit)
        assert total == count(text)
        assert fits == longest


def test_token_counts_of_odd_rows(odd, rows):
    found = prefix_tokens.token_counts(odd.withColumn("n_tokens", F.lit(-1)), BYTES)
    expected = [
        (d, len((t or "").encode()), count(t or ""), count(t or "") > 512) for d, t in odd.collect()
    ]
    assert rows(found, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=lambda t: tuple((v is None, str(v)) for v in t))


def test_token_counts_of_an_empty_table(docs):
    assert prefix_tokens.token_counts(docs(), BYTES).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        prefix_tokens.PrefixCounter(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())


@settings(max_examples=300, deadline=None)
@given(MIXED)
def test_pieces_are_the_librarys(codec, text):
    plain, source = codec.normalizer.apply(text)
    ids, starts, ends, decoded = pieces._encoded(codec, plain, source)
    wanted = LIBRARY.encode(text, return_type="proto").pieces
    assert ids.tolist() == LIBRARY.encode(text)
    assert decoded == LIBRARY.decode(LIBRARY.encode(text))
    assert list(zip(starts, ends)) == [(p.begin, p.end) for p in wanted]


@pytest.mark.parametrize("rule", ["identity", "nmt_nfkc", "nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("collapse", [True, False])
def test_normalisation_keeps_offsets(rule, collapse):
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, remove_extra_whitespaces=collapse, add_dummy_prefix=True, escape_whitespaces=True
    )
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(library.serialized_model_proto())
    own = pieces.Normalizer(spec.normalizer_spec)
    for text in ["", "  ", "plain words", " ﬁne  Å Ａ①  ", "一 あ\t½ ñ ", "▁ a ▁"]:
        plain, source = own.apply(text)
        wanted, offsets = library.normalize(text, with_offsets=True)
        at = [len(plain[:i].encode()) for i in range(len(plain) + 1)]
        assert plain == wanted
        assert [len(text.encode()[: source[i]].decode()) for i in at] == list(offsets)


def test_ids_alone_are_the_same_and_keep_no_texts(codec):
    """The stage that gives ids only keeps packed ids of words, in a smaller table."""
    texts = ["", "a", " two  spaces ", "tab\tand\nline", "▁marks▁ ▁▁", "naïve 漢字 🙂", *(f"w{i} v{i}" for i in range(200))]
    plain = [codec.normalizer.apply(t)[0] for t in texts]
    before = len(codec.words)
    found = codec.ids(plain)
    assert len(codec.words) == before
    assert all(type(v) is bytes for v in codec.word_ids.values())
    assert codec.word_ids.entries < codec.words.entries
    assert found == [b"".join(c.ids for c in codec.chunks(p)) for p in plain]


def test_pieces_of_odd_rows(odd, docs):
    clash = odd.withColumn("ids", F.lit("x"))
    for row in pieces.encode(clash, PIECES).collect():
        if row["doc_id"] in (1, 2):
            assert (row["ids"], row["decoded"]) == ([], "")
    wanted = sorted(
        (d is None, d or 0, ",".join(map(str, LIBRARY.encode(t or "")))) for d, t in odd.collect()
    )
    got = pieces.digests(clash, PIECES).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["ids_sha256"]) for r in got) == sorted(
        (a, b, hashlib.sha256(t.encode()).hexdigest()) for a, b, t in wanted
    )
    assert {r["doc_id"]: r["n_tokens"] for r in got}[7] == len(LIBRARY.encode("alpha beta gamma " * 20_000))
    kept = pieces.with_pieces(clash, PIECES)
    assert kept.columns == ["doc_id", "text", "n_tokens", "ids"]
    assert {r["doc_id"]: r["ids"] for r in kept.collect()}[5] == LIBRARY.encode("alpha beta")
    assert pieces.digests(docs(), PIECES).count() == 0


def test_spans_cover_the_text(codec):
    text = "größe und 🙂 maß"
    plain, source = codec.normalizer.apply(text)
    _, starts, ends, _ = pieces._encoded(codec, plain, source)
    assert starts[0] == 0 and ends[-1] == len(text.encode())
    assert np.all(starts[1:] == ends[:-1])
