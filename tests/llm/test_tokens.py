"""SentencePiece coding and packing, against their libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from frames import SF, awkward, documents, groups, read
from tokenizers import Tokenizer

from fareline.llm import packing, pieces
from fareline.llm.queries import LLM_QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_coding_query_against_the_library(spark, library):
    expected = {}
    for r in read(spark, SF).collect():
        ids = library.encode(r.text or "")
        expected[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256(library.decode(ids).encode()).hexdigest())
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256)
             for r in LLM_QUERIES["op2_sentencepiece"](spark, SF).collect()}
    assert found == expected


def test_random_texts_are_coded_as_by_the_library(library):
    model, rng = pieces.PieceModel(PIECES), random.Random(11)
    parts = [" ", "  ", "\n", " \n", "▁", "a", "the", "ing", "é", "中", "😀", "\t", "aaaa", "...", "12", "\x00", "abab", "tion",
             "́", "<s>", "<0x0A>", "----", "\r\n"]
    vocabulary = [library.id_to_piece(i) for i in range(259, library.get_piece_size())]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, "ab" * 3000, " " * 300]
    for text, ids in zip(texts, model.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text), repr(text)
        assert model.decode(ids) == library.decode(ids.tolist())


def test_forgetting_words_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(pieces, "_CACHED_WORDS", 3)
    monkeypatch.setattr(pieces, "_ROUND_CHARS", 5)
    model = pieces.PieceModel(PIECES)
    for text in ("several words of a text", "others follow here", "several words again"):
        assert model.encode([text])[0].tolist() == library.encode(text)


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        (tmp_path / "empty.model").write_bytes(b"")
        pieces.PieceModel(str(tmp_path / "empty.model"))


def test_awkward_rows_are_coded(spark):
    rows = pieces.encode_and_decode(awkward(spark), PIECES).collect()
    assert len(rows) == 10
    by_id = groups((r.doc_id, r) for r in rows)
    assert by_id[1][0].ids == [] == by_id[2][0].ids and by_id[1][0].decoded == ""
    assert by_id[3][0].decoded == " \n" and by_id[6][0].decoded == "Ünïcode 𝒳 text\x00with controls"
    assert pieces.encode_and_decode(documents(spark, "a").filter("false"), PIECES).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def check_packing(rows, texts, tokenizer, window=2048):
    """Every id once and in order, sequences full from zero on; the share of padding."""
    by_doc, by_sequence = groups((r.doc_id, r) for r in rows), groups((r.sequence_id, r) for r in rows)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= window
    return 1 - sum(r.length for r in rows) / (window * len(by_sequence))


def test_packing_query(spark, tokenizer):
    texts = {r.doc_id: r.text for r in read(spark, SF).collect()}
    assert check_packing(LLM_QUERIES["op8_packing"](spark, SF).collect(), texts, tokenizer) < 0.03


def test_words_are_encoded_as_whole_texts_are(tokenizer):
    words, rng = packing.WordTokens(WORDS), random.Random(5)
    parts = ["The", "ẖ", "H̱", "́", "École", "don't", "'S", "ing.", "a,b", "!!", "%%%", "<|endoftext|>",
             "<|ENDOFTEXT|>", "12", " ", "  ", "\n", "\x0b", "\x1c", "\x85", " ", "中文", "İ", "Σ", "Z.", "z?!", "…", "ﬁ", "ª", "ŉ",
             "ǅ", "Ǆ", "ß", "ẞ", "Straße", "ÀÉÎ", "ñandú", "Ƞ", "ɐ"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == tokenizer.encode(
            text, add_special_tokens=False).ids, repr(text)


def test_differencing_is_near_equal_and_complete():
    rng = random.Random(2)
    for windows in (1, 2, 7, 40):
        sizes = [rng.randint(1, 512) for _ in range(windows * 8)]
        dealt = packing.differencing(sizes, windows)
        assert sorted(i for window in dealt for i in window) == list(range(len(sizes)))
        sums = [sum(sizes[i] for i in window) for window in dealt]
        assert len(sums) == windows and max(sums) - min(sums) < 256
    assert packing.differencing([5], 3) == [[0]]
    assert packing.balanced([], 10) == []


def test_windows_are_added_until_none_is_over():
    assert sorted(map(sorted, packing.balanced([6, 6, 6], 10))) == [[0], [1], [2]]
    assert len(packing.balanced([5, 5, 5, 5], 10)) == 2
    with pytest.raises(ValueError):
        packing.balanced([11], 10)


def test_awkward_rows_are_packed(spark):
    rows = packing.pack(awkward(spark), WORDS).collect()
    by_id = groups((r.doc_id, r) for r in rows)
    assert [r.doc_tokens for r in by_id[1]] == [1] == [r.doc_tokens for r in by_id[2]]
    assert len(by_id[4]) == 2 and len(by_id[None]) == 2 and sum(r.length for r in by_id[5]) == by_id[5][0].doc_tokens
    assert packing.pack(documents(spark, "a").filter("false"), WORDS).count() == 0
