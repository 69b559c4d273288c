"""Encoding and decoding against the library, text by text."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import rank_bpe
from tidemark.llm.memo import ENTRY_BYTES, Memo

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = " \n\t\x1c\x85|ENDOF  aAéßΣİ1'ts.,<|endoftext|>😀́²ǅ漢字"
LIBRARY = {path: Tokenizer.from_file(path) for path in (WORD, BYTE)}


def library_ids(path, text):
    return LIBRARY[path].encode(text, add_special_tokens=False).ids


def one(model, text):
    return np.frombuffer(next(iter(model.encode([text.encode()]))), model.dtype).tolist()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_any_text(path):
    model = rank_bpe.RankBpe(path)

    @settings(max_examples=500, deadline=None)
    @given(st.text(st.sampled_from(ALPHABET), max_size=80) | st.text(max_size=40) | st.text(st.characters(codec="ascii"), max_size=60))
    def same(text):
        ids = library_ids(path, text)
        assert one(model, text) == ids
        assert model.decode(ids) == LIBRARY[path].decode(ids, skip_special_tokens=False)

    same()


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_any_ids(path):
    model = rank_bpe.RankBpe(path)

    @settings(max_examples=200, deadline=None)
    @given(st.lists(st.integers(0, 50_500), max_size=30))
    def same(ids):
        assert model.decode(ids) == LIBRARY[path].decode(ids, skip_special_tokens=False)

    same()
    assert model.decode([None, -1, 10**9]) == ""


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_scan_and_heap_agree(monkeypatch, path):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdeinorst"), n)) for n in rng.integers(1, 60, 300)]
    words += ["a" * n for n in range(1, 60)] + ["ab" * 30, "anana" * 12]
    scanned = rank_bpe.RankBpe(path).words([w.encode() for w in words])
    monkeypatch.setattr(rank_bpe, "SHORT", 1)
    assert rank_bpe.RankBpe(path).words([w.encode() for w in words]) == scanned


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_long_texts(monkeypatch, path):
    monkeypatch.setattr(rank_bpe, "BATCH_BYTES", 50)
    text = "Some words, and  more\nwords — don't stop; <|endoftext|> " * 40 + "xyz" * 2000
    assert one(rank_bpe.RankBpe(path), text) == library_ids(path, text)


def plain(path, docs):
    out = []
    for r in docs.select("doc_id", "text").collect():
        ids = library_ids(path, r.text or "")
        texts = " ".join(map(str, ids)), LIBRARY[path].decode(ids, skip_special_tokens=False)
        out.append((r.doc_id, len(ids), *(hashlib.sha256(t.encode()).hexdigest() for t in texts)))
    return sorted(out, key=str)


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("name", ["odd_docs", "documents", "no_docs"])
def test_tables(request, path, name):
    docs = request.getfixturevalue(name)
    got = rank_bpe.digest(rank_bpe.decode(rank_bpe.encode(docs, path), path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(path, docs)


def test_null_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (None, [320, None, 10**6])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in rank_bpe.decode(rows, WORD).collect()}
    assert got == {1: None, 2: "", None: LIBRARY[WORD].decode([320])}


def test_other_files_are_refused(tmp_path):
    file = tmp_path / "x.json"
    file.write_text('{"model": {"type": "Unigram", "vocab": [], "merges": []}}')
    with pytest.raises(ValueError, match="Unigram"):
        rank_bpe.RankBpe(str(file))


def test_memo_holds_its_bytes():
    memo = Memo(limit=100 * ENTRY_BYTES)
    for i in range(100):
        words = [b"%d-%d" % (i, k) for k in range(20)] + [b"often", b"x" * 1000]
        new = memo.unseen(words)
        assert (b"often" in new) == (i == 0)
        memo.add(new, new)
        assert all(memo.known[w] == w for w in words)
        assert len(memo) <= 100 + 2 * 22  # a generation is closed by the batch that fills it
    memo.unseen([])
    assert b"x" * 1000 not in memo.known
    memo.clear()
    assert len(memo) == 0
