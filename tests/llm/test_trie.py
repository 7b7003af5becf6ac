"""Byte-level BPE against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from transhume.llm import trie
from transhume.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = trie.encoder(PATH)
PARTS = ["a", "aa", "b", " ", "  ", "'s", "ll", "é", "日", "本", "\U0001f600", "\n", "\t", "\x1c", "\x85", "　", "٣", "²", "<|endoftext|>", "<|", "!"]
PARTS += ["--", "\xad", "the", "ing", "ation", "́", "ñ", "\x00", "퟿", "࢏", "\U00016ea0"]


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join) | st.text(max_size=60))
def test_ids_and_texts(text):
    (ids,) = ENCODER.encode([text])
    assert ids == packed(ids_of(text)) and ENCODER.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 5000, "-" * 3000, " " * 2000 + "x", "日本語" * 3000, "abc" * 30_000, "=-" * 2000, "\n" * 999])
def test_long_words(text):
    assert ENCODER.encode([text]) == [packed(ids_of(text))]


def test_every_character_is_of_the_class_that_the_library_sees():
    classes = LIBRARY.pre_tokenizer.pre_tokenize_str
    points = [*range(0x3100), *random.Random(1).sample(range(0x3100, 0x110000), 20_000)]
    points += [int(r.split("-")[k % len(r.split("-"))], 16) for k in (0, 1) for r in trie._UNASSIGNED.split()]
    for c in points:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}1{chr(c)}!{chr(c)}  {chr(c)}"
            assert [w for some in trie.words_of(text) for w in some] == [text[a:b] for _, (a, b) in classes(text)], hex(c)


def test_any_ids_decode_as_the_library_decodes_them():
    rng = random.Random(4)
    for _ in range(1000):
        ids = [rng.randrange(50_300) for _ in range(6)]
        assert ENCODER.decode(packed(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_prefixes_are_shared_and_every_word_comes_out():
    words = {"the", "them", "theme", "then", "t", "thé", " the", "x" * 300, "x" * 301}
    assert trie.encode_words(ENCODER.vocabulary, words) == {w: packed(ids_of(w)) for w in words}
    assert trie.encode_words(ENCODER.vocabulary, set()) == {}


def test_words_are_forgotten_without_harm(monkeypatch):
    monkeypatch.setattr(trie, "REMEMBERED", 5)
    monkeypatch.setattr(trie, "TRIE", 40)
    monkeypatch.setattr(trie, "WORDS", 16)
    own, rng = trie.Encoder(PATH), random.Random(2)
    texts = [" ".join(rng.choice(["one", "two", "three", "four", "fünf", "<|endoftext|>", str(rng.random())]) for _ in range(30)) for _ in range(60)]
    assert own.encode(texts) == [packed(ids_of(t)) for t in texts]


def test_other_tokenizers_are_refused():
    with pytest.raises(trie.VocabularyError):
        trie.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_query_on_the_given_table(spark):
    got = {r.doc_id: r for r in QUERIES["op12_bpe"](spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, text in docs:
        ids = ids_of(text or "")
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want = len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == want


def test_odd_rows_and_columns(spark):
    rows = [(None, "no id", "r", 1), (1, None, "r", 1), (2, "", "r", 1), (3, "x y " * 20_000, "r", 1), (3, "x y " * 20_000, "r", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, `a.b` int")
    found = trie.encode(df, PATH, decoded=True)
    assert found.columns == ["doc_id", "text", "row", "a.b", "n_tokens", "ids", "decoded"]
    assert all(r.decoded == (r.text or "") and r.ids == packed(ids_of(r.text or "")) and r["a.b"] == 1 for r in found.collect())
    back = trie.decode(found, PATH, text_col="again")
    assert all(r.again == r.decoded for r in back.collect()) and back.columns[-1] == "again"
    assert trie.encode(df.limit(0), PATH).count() == 0
    assert trie.encode(df.withColumnRenamed("row", "ids"), PATH).columns == ["doc_id", "text", "a.b", "n_tokens", "ids"]
    assert trie.encode(df, PATH, keep=[]).columns == ["n_tokens", "ids"]
