"""BPE over a trie of words against the tokenizers library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from placerank.llm.bpe_trie import TrieEncoder, Vocabulary, decode_documents, encode_documents, recoded_digests
from placerank.llm.tokenize import tokenizer_path

BYTES = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def test_ids_and_decoded_texts_are_the_library_s(library):
    parts = ["a", "B", " ", "  ", "\n", "\t", "é", "É", "'s", "1", "²", ",", ".", "中", "ß", "İ", "<|endoftext|>", "<|endof", "\x1f", "\x00", "😀",
             "\r", "x\ny", " the", "word.\nNext", "\x85", "aaaa", "ing", "----", "ll", "12345"]
    r, enc = random.Random(5), TrieEncoder(BYTES, most_bytes=200_000)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(r.choice("abcdeilnorst") for _ in range(r.randint(1, 60))) for _ in range(2000)]
    texts += ["a" * 3000, "ab" * 2000, "x" * 257, "<|endoftext|>" * 3, "<|endoftext|> end"]
    for i in range(0, len(texts), 500):  # the memory is replaced on the way
        part = texts[i : i + 500]
        for text, got, want in zip(part, enc.encode(part), library.encode_batch(part, add_special_tokens=False), strict=True):
            ids = np.frombuffer(got, "<i4").tolist()
            assert ids == want.ids, text
            assert enc.vocabulary.decode(ids) == library.decode(want.ids, skip_special_tokens=False)


def test_any_ids_decode_as_the_library_decodes(library):
    r, vocabulary = random.Random(6), Vocabulary(BYTES)
    for _ in range(3000):
        ids = [r.randrange(50_300) for _ in range(r.randint(0, 8))]
        assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_a_word_is_encoded_the_same_whatever_shares_its_prefix():
    vocabulary = Vocabulary(BYTES)
    words = {b"inter", b"international", b"internationally", b"inte", b"zzz", b" ", b"interx"}
    together = vocabulary.encode_words(words)
    assert together == {w: vocabulary.encode_words({w})[w] for w in words}


def test_words_are_kept_without_their_signs_and_runs_decode_together(library):
    enc = TrieEncoder(BYTES)
    texts = ["a " + " ".join(w + s for w in ("word", "été") for s in (",", ".", "!!", "...", "")) + end for end in ("", "  ", "\nword", "<|endoftext|>")]
    got = [np.frombuffer(x, "<i4") for x in enc.encode([*texts, None])]
    want = [e.ids for e in library.encode_batch([*texts, ""], add_special_tokens=False)]
    assert [g.tolist() for g in got] == want
    assert enc.vocabulary.decode_runs(pa.array(np.concatenate(got)), np.cumsum([0, *map(len, got)])) == [*texts, ""]
    alone = TrieEncoder(BYTES)
    alone.encode([texts[0], texts[2]])
    assert {p for p in alone.rest if p[0] not in "\x00\x01"} == {"word", "été"}


def test_the_walk_s_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr("placerank.llm.bpe_trie.MOST_PAIRS", 50)
    r, vocabulary = random.Random(8), Vocabulary(BYTES)
    words = {"".join(r.choice("abcdeilnorstéß") for _ in range(r.randint(1, 20))) for _ in range(500)}
    got = vocabulary.encode_words({w.encode() for w in words})
    assert all(np.frombuffer(got[w.encode()], "<i4").tolist() == library.encode(w, add_special_tokens=False).ids for w in words)
    assert max(len(vocabulary.pairs), len(vocabulary.steps)) <= 50


def test_documents(spark, odd, nothing, library):
    def digest(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())

    rows = odd.select("doc_id", "text").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    assert sorted((tuple(r) for r in recoded_digests(odd, BYTES).collect()), key=key) == sorted((digest(*r) for r in rows), key=key)
    back = decode_documents(encode_documents(odd, BYTES), BYTES).collect()
    assert sorted((r["doc_id"] or -1, r["decoded"]) for r in back) == sorted((r["doc_id"] or -1, r["text"] or "") for r in rows)
    assert recoded_digests(nothing, BYTES).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        Vocabulary(tokenizer_path("word_bpe_49k.json"))
