"""SentencePiece encoding and decoding against the library."""

import random
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces, tokens
from tidemark.llm.lattice import Lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("name", ["odd_docs", "documents", "no_docs"])
def test_ids(request, library, name):
    docs = request.getfixturevalue(name)
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, library.encode(r.text or "")) for r in rows]
    encoded = pieces.encode_pieces(docs, MODEL)
    assert sorted((tuple(r) for r in encoded.collect()), key=str) == sorted(want, key=str)
    decoded = [tuple(r) for r in pieces.decode_pieces(encoded, MODEL).collect()]
    assert sorted(decoded, key=str) == sorted(((d, library.decode(ids) if ids else "") for d, ids in want), key=str)
    checked = [tuple(r) for r in pieces.checked_pieces(docs, MODEL).collect()]
    assert sorted(checked, key=str) == sorted(
        ((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), "▁" not in (r.text or "")) for (d, ids), r in zip(want, rows)),
        key=str,
    )


def test_null_lists(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [None, 263])], "doc_id bigint, ids array<int>")
    got = {r.doc_id: r.text for r in pieces.decode_pieces(df, MODEL).collect()}
    assert got[1] == got[2] == "" and len(got[3]) > 0


ALPHABET = " ▁\n\t\0abcehilnorstTE.,;!'019éß漢😀-()<0x>²m"


def test_texts_alike(library):
    transducer, encoder = pieces.Transducer(MODEL), pieces.PieceEncoder(MODEL)

    @settings(max_examples=500, deadline=None)
    @given(st.text(st.sampled_from(ALPHABET), max_size=50) | st.text(max_size=30))
    def same(text):
        ids = library.encode(text)
        assert transducer.encode(text) == ids
        assert np.frombuffer(next(iter(encoder(iter([text.encode()])))), "<u2").tolist() == ids
        assert transducer.decode(ids) == library.decode(ids)

    same()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 300) | st.integers(0, 31999), max_size=30))
def test_any_ids_decode_alike(ids):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ids = [i for i in ids if i > 2]
    assert pieces.Transducer(MODEL).decode(ids) == library.decode(ids)


def test_long_texts_are_cut(monkeypatch, library):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 60)
    text = "Some words, and  more\nwords — don't stop; " * 30 + "y" * 300 + " end"
    got = next(iter(pieces.PieceEncoder(MODEL)(iter([text.encode()]))))
    assert np.frombuffer(got, "<u2").tolist() == library.encode(text)


def test_one_path_is_finite():
    """All ways to cut a few words into pieces: exactly one has only finite steps, the one that is found."""
    transducer = pieces.Transducer(MODEL)

    def paths(rest, left=""):
        if not rest:
            yield []
        for n in range(1, len(rest) + 1):
            if (rest[:n] in transducer.ids or n == 1) and transducer.step(left, rest[:n]):
                yield from ([rest[:n], *more] for more in paths(rest[n:], rest[:n]))

    for word in ("▁tokenization", "▁Donaudampfschiff", "aaaaaaa", "▁▁▁▁▁", "▁x漢y", "ñandú"):
        assert list(paths(word)) == [transducer.path(word)] == [transducer.merged(word)]


def test_only_the_escaped_space_is_a_prefix():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = pieces.Transducer(MODEL)
    word = library.encode("word")
    for ids in ([35], [35, 35], [35, *word], [*word, 35], word, [word[0], *word], [100, 35]):
        assert model.decode(ids) == library.decode(ids)


def _random_texts(model, n, seed=11):
    """Texts of characters of every category, of pieces, and of both."""
    rng = random.Random(seed)
    every = [c for c in map(chr, range(1, 0x30000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    pieces_ = [p.replace("▁", " ") for p in model.ids]
    own = sorted({c for p in pieces_ for c in p})
    kinds = [(own, 25), (pieces_, 8), (every, 15), (list("abcdeinorst .,²m"), 60), ([*own, *".,!?;:²▁\n "], 20)]
    for _ in range(n):
        signs, most = rng.choice(kinds)
        yield "".join(rng.choices(signs, k=rng.randint(1, most)))


def test_random_texts_of_all_categories(library):
    model = pieces.Transducer(MODEL)
    texts = ["25 m².", "E=mc².", "x².y", *_random_texts(model, 20_000)]
    encoder = pieces.PieceEncoder(MODEL)
    assert encoder.lattice is not None
    got = encoder(iter([t.encode() for t in texts]))
    wrong = [t for t, ids in zip(texts, got) if np.frombuffer(ids, "<u2").tolist() != library.encode(t)]
    assert wrong == []


def test_lattice_goes_back_where_no_arc_goes_on():
    """Small made models, ties of scores among them: paths are what merging gives."""
    rng = random.Random(3)
    for _ in range(60):
        texts = {"".join(rng.choices("ab", k=rng.randint(2, 5))) for _ in range(rng.randint(1, 12))}
        by_length = enumerate(sorted(texts, key=lambda t: (len(t), t)))
        scores = {t: -float(rng.randint(0, 6) if rng.random() < 0.3 else i) for i, t in by_length}
        model = pieces.Transducer.__new__(pieces.Transducer)
        model.scores = scores
        try:
            lattice = Lattice(scores, {t: i for i, t in enumerate(scores)})
        except ValueError:
            continue
        words = ["".join(rng.choices("abc", k=rng.randint(0, 14))) for _ in range(60)]
        trail, depth = lattice.paths(words)
        for word, row, n in zip(words, trail, depth.tolist()):
            ends = lattice.size[row[:n]].cumsum().tolist()
            assert [word[a:b] for a, b in zip([0, *ends], ends)] == model.merged(word)
