"""Token counts and token ids, exactly as the tokenizer's library gives them.

A text is split at boundaries where the tokenizer can't join what stands on
either side, so its ids are the ids of the pieces, one after the other.  The
pieces that a task has not met lately go to the library in batches of about
equal bytes (plain words of a byte-pair file to ``rank_bpe``, which has the same
answer sooner); answers are remembered within a fixed number of bytes, and
forgotten when the task ends.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tidemark.llm.frames import id_text
from tidemark.llm.memo import MEMO_BYTES, Memo

# Unicode white space, and the pattern of tokenizers that drop it.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
DROPPED_SPACE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

BATCH_BYTES = 4 << 20
JOINED_PIECES = 100

_PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")
_GAP = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")
_STOP = re.compile(rb"[.,](?<=[a-z][.,])")
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
# Words of a to z and the small letters of Latin-1, which lower-casing, NFC and splitting leave as they are.
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def words_of(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text for a tokenizer that lower-cases and drops white space.

    Cut at ASCII white space only; other white space stays in a word and is left
    to the library.  A full stop or comma after a letter begins a piece of its
    own there, so that the words without it are met again.
    """
    return _STOP.sub(rb" \g<0>", text.lower()).split()  # A-Z only, whatever may follow them


def words_in(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` of all texts, one after the other; and the place of each text's first word, and the end."""
    raw = np.frombuffer(b"\n".join(texts).lower(), np.uint8)
    kept, letter = ~_IS_SPACE[raw], raw - ord("a") < 26  # unsigned: what is less than a wraps around
    begins = kept.copy()
    begins[1:] &= ~kept[:-1] | ((raw[1:] == ord(".")) | (raw[1:] == ord(","))) & letter[:-1]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.searchsorted(np.flatnonzero(begins), np.append(0, (sizes + 1).cumsum()))
    chars = raw[kept]
    places = np.append(np.flatnonzero(begins[kept]), len(chars))
    buffers = [None, pa.py_buffer(places), pa.py_buffer(chars)]
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, buffers), firsts


def _values(column: pa.LargeBinaryArray, firsts: np.ndarray | slice = slice(None)) -> list[bytes]:
    """The values of a column that has no nulls and begins with its buffers; from each of ``firsts`` to the next as one."""
    _, offsets, raw = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1)[firsts].tolist()
    raw = raw.to_pybytes() if raw is not None else b""
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


def drops_space(config: dict) -> bool:
    """Whether the file lower-cases, then drops white space by the pattern that is known here."""
    parts = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return bool(
        parts[0].get("type") == "Split"
        and parts[0].get("invert")
        and parts[0].get("behavior") == "Removed"
        and parts[0].get("pattern", {}).get("Regex") == DROPPED_SPACE
        and [n.get("type") for n in (config.get("normalizer") or {}).get("normalizers", ())] == ["NFC", "Replace", "Lowercase"]
    )


def byte_cutter(config: dict) -> Callable[[str], list[str]] | None:
    """How texts are cut for a byte-level tokenizer; None if they must stay whole.

    Its patterns take one plain space with the word after it, so a piece is a
    run without white space and that space, or white space before it.
    """
    pre = config.get("pre_tokenizer") or {}
    if (
        config.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex")
        and not pre.get("add_prefix_space")
    ):
        return _PIECES.findall
    return None


def segments(text: str, size: int = BATCH_BYTES) -> Iterator[str]:
    """``text`` cut before single spaces between words, each part ``size`` characters or little more."""
    start = 0
    while len(text) - start > size:
        gap = _GAP.search(text, start + size)
        if gap is None:
            break
        yield text[start : gap.start()]
        start = gap.start()
    yield text[start:] if start else text


class Encoder:
    """Encodes texts with a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file.

    Texts come as UTF-8 and are cut as they are if the tokenizer drops white
    space.  ``lengths``: give numbers of tokens instead of ids.  Ids come as
    bytes, two for each id if the vocabulary allows it and four otherwise.
    """

    def __init__(self, path: str, lengths: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._begin(lengths)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._ids = lambda texts: model.encode(texts, num_threads=1)
            size = model.get_piece_size()
        else:
            model = Tokenizer.from_file(path)
            self._ids = self._by(model)
            with open(path, encoding="utf-8") as f:
                config = json.load(f)
            if drops_space(config):
                self.cut, self.by_bytes = words_of, True
                self._plain = self._word_ranks(path)
            else:
                self.cut = byte_cutter(config)
            added = config.get("added_tokens", ())
            self.special = tuple(t["content"].lower() for t in added)
            self._special_bytes = tuple(x.encode() for x in self.special)
            for t in added:
                if t["special"] and not (t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]):
                    self.mark = (t["content"], t["id"])
            size = model.get_vocab_size(with_added_tokens=True)
        self.kind = "H" if size <= 1 << 16 else "I"

    def _begin(self, lengths: bool, memo_bytes: int = MEMO_BYTES) -> None:
        self.memo = Memo(memo_bytes)
        self.mark: tuple[str, int] | None = None
        self.special: tuple[str, ...] = ()
        self._special_bytes: tuple[bytes, ...] = ()
        self.cut: Callable[[str], list[str]] | Callable[[bytes], list[bytes]] | None = None
        self.by_bytes = False
        self._plain: Callable[[list[bytes]], list[int | bytes]] | None = None
        self.join = sum if lengths else b"".join
        self._lengths = lengths

    @staticmethod
    def _by(model: Tokenizer) -> Callable[[list[str]], list[list[int]]]:
        return lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> list[int | bytes]:
        ids = self._ids(texts)
        return [len(x) for x in ids] if self._lengths else [array(self.kind, x).tobytes() for x in ids]

    def _encode_pieces(self, pieces: list[str], encode: Callable[[list[str]], list[list[int]]]) -> Iterator[int | bytes]:
        """As ``_encode``, many pieces in a text with a special token between them, which none of them holds."""
        if self.mark is None:
            yield from self._encode(pieces)
            return
        text, mark = self.mark
        joined = [text.join(pieces[i : i + JOINED_PIECES]) for i in range(0, len(pieces), JOINED_PIECES)]
        for ids in encode(joined):
            ids = np.array(ids, np.int64)
            ends = [*np.flatnonzero(ids == mark).tolist(), len(ids)]
            if self._lengths:
                yield from (np.diff(ends, prepend=-1) - 1).tolist()
            else:
                raw = ids.astype(self.kind)
                width, raw, start = raw.itemsize, raw.tobytes(), 0
                for end in ends:
                    yield raw[start : end * width]
                    start = (end + 1) * width

    def _word_ranks(self, path: str) -> Callable[[list[bytes]], list[int | bytes]] | None:
        from tidemark.llm.rank_bpe import RankBpe  # it cuts texts by what this module knows

        try:
            model = RankBpe(path)
        except ValueError:
            return None
        width = np.dtype(model.dtype).itemsize
        return (lambda words: [len(x) // width for x in model.words(words)]) if self._lengths else model.words

    def _learn(self, pieces: set[str] | list[bytes]) -> None:
        """Puts the results of all pieces in ``memo``."""
        new = self.memo.unseen(pieces)
        if self._plain is not None:
            plain = list(filter(_PLAIN.fullmatch, new))
            self.memo.add(plain, self._plain(plain))
            new = list(set(new).difference(plain))
        texts = [p.decode() for p in new] if self.by_bytes else new
        self.memo.add(new, list(self._encode_pieces(texts, self._ids)))

    def forget(self) -> None:
        self.memo.clear()

    def _batch(self, texts: list[bytes]) -> list[int | bytes]:
        if self.by_bytes:
            return self._batch_of_words(texts)
        texts = [t.decode() for t in texts]
        if self.cut is None:
            return self._encode(texts)
        cut = [None if self._has_special(t) else self.cut(t) for t in texts]
        self._learn(set().union(*filter(None, cut)))
        known = self.memo.known.__getitem__
        return [
            self.join(map(known, c)) if c is not None else self._encode([t])[0]
            for t, c in zip(texts, cut)
        ]

    def _batch_of_words(self, texts: list[bytes]) -> list[int | bytes]:
        """Each distinct word is looked up once; Arrow finds them and puts their results together."""
        whole = [self._has_special(t) for t in texts]
        words, firsts = words_in([b"" if w else t for w, t in zip(whole, texts)])
        coded = words.dictionary_encode()
        distinct = _values(coded.dictionary)
        self._learn(distinct)
        results = list(map(self.memo.known.__getitem__, distinct))
        if self._lengths:
            ends = np.append(0, np.array(results, np.int64)[coded.indices.to_numpy()].cumsum())[firsts]
            done = np.diff(ends).tolist()
        else:
            ids = pa.array(results, pa.large_binary()).take(coded.indices)
            done = _values(ids, firsts)
        return [self._encode([t.decode()])[0] if w else d for w, t, d in zip(whole, texts, done)]

    def _has_special(self, text: str | bytes) -> bool:
        """Whether a special string may stand in the text, in any case of its letters."""
        low = text.lower()
        return any(x in low for x in (self._special_bytes if isinstance(text, bytes) else self.special))

    def _cut_long(self, text: bytes) -> Iterator[bytes]:
        if self.cut is None or len(text) <= BATCH_BYTES or self._has_special(text):
            yield text
        elif self.by_bytes:
            start = 0
            while 0 <= (end := text.find(b" ", start + BATCH_BYTES)):
                yield text[start:end]
                start = end
            yield text[start:]
        else:
            yield from (part.encode() for part in segments(text.decode()))

    def __call__(self, texts: Iterator[bytes]) -> Iterator[int | bytes]:
        """The result of each text, in order, encoded in batches of about ``BATCH_BYTES``."""
        batch, sizes, held = [], [], 0
        for text in texts:
            n = 0
            for part in self._cut_long(text):
                batch.append(part)
                n += 1
                held += len(part)
            sizes.append(n)
            if held >= BATCH_BYTES:
                yield from self._flush(batch, sizes)
                batch, sizes, held = [], [], 0
        yield from self._flush(batch, sizes)

    def _flush(self, batch: list[bytes], sizes: list[int]) -> Iterator[int | bytes]:
        # the parts of a long text go one by one, so that no batch grows with it
        done = self._batch(batch) if len(batch) == len(sizes) else [self._batch([x])[0] for x in batch]
        at = 0
        for n in sizes:
            yield done[at] if n == 1 else self.join(done[at : at + n])
            at += n


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, lengths: bool) -> Encoder:
    """One encoder per worker, tokenizer and kind of result."""
    key = (path, lengths)
    if key not in _encoders:
        _encoders[key] = Encoder(path, lengths)
    return _encoders[key]


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 texts of an Arrow column, made one by one."""
    return (x.as_py() for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()))


def token_counts(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``df``.

    Whole texts are counted, without begin, end or added special tokens; special
    strings inside a text count as the library counts them by default.  A null
    text is empty (no bytes, no tokens), a null id stays null, repeated rows
    give a row each, and an empty table gives an empty result.  Other columns,
    whatever their names, are not read.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoder(tokenizer, lengths=True)
        try:
            for batch in batches:
                text = batch.column("text")
                n = pa.array(count(texts_of(text)), pa.int64())
                yield pa.record_batch(
                    [batch.column("doc_id"), pc.cast(pc.binary_length(text), pa.int64()), n, pc.greater(n, limit)],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )
        finally:
            count.forget()

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )


TOKEN_ROWS = "part int, local_start bigint, doc_id bigint, n_tokens bigint, ids binary, width int"


def token_rows(tokenizer: str, end_id: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turns batches of ``doc_id, text`` into batches of ``TOKEN_ROWS``, within a task.

    ``part`` is the task, ``local_start`` the number of ids before the row there.
    ``ids`` has ``width`` bytes an id, little-endian.  Both places depend on how
    rows meet tasks: write the rows before relying on them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, lengths=False)
        width = array(encode.kind).itemsize
        end = b"" if end_id is None else end_id.to_bytes(width, "little")
        part, start = TaskContext.get().partitionId(), 0
        try:
            for batch in batches:
                rows, first = _Rows(batch.column("doc_id"), part, width), 0
                for ids in encode(texts_of(batch.column("text"))):
                    ids += end
                    rows.add(start, ids)
                    start += len(ids) // width
                    if rows.held >= BATCH_BYTES:
                        yield rows.take(first)
                        first += rows.taken
                if rows.starts:
                    yield rows.take(first)
        finally:
            encode.forget()

    return run


class _Rows:
    """Rows of the token table, put out when they hold enough bytes."""

    def __init__(self, doc_ids: pa.Array, part: int, width: int) -> None:
        self.doc_ids, self.part, self.width = doc_ids, part, width
        self.starts, self.ids, self.held, self.taken = [], [], 0, 0

    def add(self, start: int, ids: bytes) -> None:
        self.starts.append(start)
        self.ids.append(ids)
        self.held += len(ids)

    def take(self, first: int) -> pa.RecordBatch:
        n = len(self.starts)
        out = pa.record_batch(
            [
                pa.array([self.part] * n, pa.int32()),
                pa.array(self.starts, pa.int64()),
                self.doc_ids.slice(first, n),
                pa.array([len(x) // self.width for x in self.ids], pa.int64()),
                pa.array(self.ids, pa.binary()),
                pa.array([self.width] * n, pa.int32()),
            ],
            ["part", "local_start", "doc_id", "n_tokens", "ids", "width"],
        )
        self.starts, self.ids, self.held, self.taken = [], [], 0, n
        return out

