"""Byte-pair encoding and decoding with a contiguous array of ranks for each word.

A short word is the array of its parts and the array of the ranks of its
neighbouring pairs.  The smallest rank is looked for by a scan, the boundary
there is deleted, and the two ranks beside it are looked up again, until no pair
has a rank.  Each step takes one part from a word, so all words that began with
the same number of symbols stay arrays of equal length, and one step of numpy
does it for all of them.  The scan takes the square of a word's length, so long
words keep their ranks in a heap instead, with the same result.

The file's own normaliser and pattern are applied as the library has them; only
words of printable ASCII and small Latin-1 letters, which are nearly all, are
normalised and split here.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.frames import id_text
from tidemark.llm.memo import Memo
from tidemark.llm.tokens import BATCH_BYTES, byte_cutter, drops_space, texts_of, words_of

# Symbols up to which a word's ranks are scanned.
SHORT = 48

_NONE = np.int32(2**31 - 1)
_EMPTY = np.int64(-1)
# The words of printable ASCII, by the pattern that drops white space.
_ASCII = re.compile(rb"[!-~]+")
_ASCII_WORDS = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
# Letters that lower-casing, NFC and splitting leave as they are.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def byte_symbols() -> list[str]:
    """The sign that stands for each byte in vocabularies of bytes: its own if printable, else one from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


class Pairs:
    """Rank of a pair of ids, by open addressing, for many pairs at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray) -> None:
        keys = left.astype(np.int64) << 32 | right
        self._bits = max(4, int(len(keys) * 4).bit_length())
        self._keys = np.full(1 << self._bits, _EMPTY)
        self._ranks = np.full(1 << self._bits, _NONE)
        ranks, slots = np.arange(len(keys), dtype=np.int32), self._slot(keys)
        while len(keys):  # of the keys that want one free place the first takes it, the others go on
            free = self._keys[slots] == _EMPTY
            first = np.zeros(len(keys), bool)
            first[np.unique(slots, return_index=True)[1]] = True
            put = free & first
            self._keys[slots[put]], self._ranks[slots[put]] = keys[put], ranks[put]
            keys, ranks, slots = keys[~put], ranks[~put], (slots[~put] + 1) & (1 << self._bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self._bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slots = self._slot(keys)
        met = self._keys[slots]
        out = np.where(met == keys, self._ranks[slots], _NONE)
        rest = np.flatnonzero((met != keys) & (met != _EMPTY))
        while len(rest):
            slots[rest] = (slots[rest] + 1) & (1 << self._bits) - 1
            met = self._keys[slots[rest]]
            hit = met == keys[rest]
            out[rest[hit]] = self._ranks[slots[rest[hit]]]
            rest = rest[~hit & (met != _EMPTY)]
        return out


class RankBpe:
    """Encodes and decodes texts with a BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model = config["model"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "unk_token", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd:
            raise ValueError(f"{path} is no plain byte-level BPE file: {odd or model.get('type')}")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        symbols = byte_symbols()
        self._byte_of = {s: b for b, s in enumerate(symbols)}
        missing = [s for s in symbols if s not in vocab or s + suffix not in vocab]
        if missing:
            raise ValueError(f"{path} has no token for the bytes {missing[:5]}")
        self._inner = np.array([vocab[s] for s in symbols], np.int32)
        self._last = np.array([vocab[s + suffix] for s in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._pairs = Pairs(
            np.array([vocab[a] for a, _ in merges], np.int64), np.array([vocab[b] for _, b in merges], np.int64)
        )
        self._joined = np.array([vocab[a + b] for a, b in merges], np.int32)
        self._rank_of = {(vocab[a], vocab[b]): rank for rank, (a, b) in reversed([*enumerate(merges)])}

        library = Tokenizer.from_file(path)
        self._normal, self._pre = library.normalizer, library.pre_tokenizer
        added = config.get("added_tokens") or []
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError(f"{path} has added tokens that take in text around them")
        self._added = {t["content"].encode(): t["id"] for t in added}
        longest = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._mark = re.compile(b"(" + b"|".join(longest) + b")") if longest else None
        self.dtype = "<u2" if library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self._one = {x: np.array([i], self.dtype).tobytes() for x, i in self._added.items()}

        self._drops_space = drops_space(config)
        cutter = None if self._drops_space else byte_cutter(config)
        self._cut: Callable[[bytes], list[bytes]] = (
            words_of if self._drops_space else (lambda t: [p.encode() for p in cutter(t.decode())]) if cutter else lambda t: [t]
        )
        self._memo = Memo()

        decoder = (config.get("decoder") or {}).get("type")
        if decoder not in (None, "ByteLevel"):
            raise ValueError(f"{path} decodes by {decoder}")
        self._by_bytes = decoder == "ByteLevel"
        self._signs: dict[int, bytes] = {}
        for sign, i in vocab.items() | {(t["content"], t["id"]) for t in added}:
            known = self._by_bytes and all(c in self._byte_of for c in sign)
            self._signs[i] = bytes(self._byte_of[c] for c in sign) if known else sign.encode()

    # words

    def _scan(self, parts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of equal length, and the final parts of the words there."""
        rows = np.arange(len(parts))
        ranks = self._pairs.ranks(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(len(parts), -1)
        while parts.shape[1] > 1:
            at = ranks.argmin(1)
            low = ranks[np.arange(len(ranks)), at]
            live = low != _NONE
            if not live.all():
                yield rows[~live], parts[~live]
                rows, parts, ranks, at, low = rows[live], parts[live], ranks[live], at[live], low[live]
                if not len(rows):
                    return
            each, n = np.arange(len(rows)), parts.shape[1]
            parts[each, at] = self._joined[low]
            kept = np.ones(parts.shape, bool)
            kept[each, at + 1] = False  # the boundary goes
            parts = parts[kept].reshape(len(rows), n - 1)
            kept = np.ones(ranks.shape, bool)
            kept[each, at] = False
            ranks = ranks[kept].reshape(len(rows), n - 2)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < n - 2)
            before, after = at[left] - 1, at[right]
            ranks[left, before] = self._pairs.ranks(parts[left, before], parts[left, before + 1])
            ranks[right, after] = self._pairs.ranks(parts[right, after], parts[right, after + 1])
        yield rows, parts

    def _heap(self, parts: list[int]) -> list[int]:
        """The same for one long word: ranks and places in a heap, boundaries as links."""
        n = len(parts)
        after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
        rank_of, joined = self._rank_of, self._joined
        waiting = [r << 40 | i for i in range(n - 1) if (r := rank_of.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(waiting)
        while waiting:
            item = heapq.heappop(waiting)
            rank, at = item >> 40, item & (1 << 40) - 1
            end = after[at]
            if parts[at] < 0 or end >= n or rank_of.get((parts[at], parts[end])) != rank:
                continue  # a part of this pair has been joined since
            parts[at], parts[end] = int(joined[rank]), -1
            after[at] = follow = after[end]
            if follow < n:
                before[follow] = at
                if (r := rank_of.get((parts[at], parts[follow]))) is not None:
                    heapq.heappush(waiting, r << 40 | at)
            if (first := before[at]) >= 0 and (r := rank_of.get((parts[first], parts[at]))) is not None:
                heapq.heappush(waiting, r << 40 | first)
        return [p for p in parts if p >= 0]

    def words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as bytes of ``dtype``."""
        out: list[bytes] = [b""] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for n, places in by_length.items():
            if n == 0:
                continue
            raw = np.frombuffer(b"".join([words[i] for i in places]), np.uint8).reshape(-1, n)
            parts = self._inner[raw]
            parts[:, -1] = self._last[raw[:, -1]]
            if n > SHORT:
                for i, row in zip(places, parts):
                    out[i] = np.array(self._heap(row.tolist()), self.dtype).tobytes()
                continue
            for rows, done in self._scan(parts):
                ids = done.astype(self.dtype)
                width, ids = ids.itemsize * ids.shape[1], ids.tobytes()
                for k, row in enumerate(rows.tolist()):
                    out[places[row]] = ids[k * width : (k + 1) * width]
        return out

    # texts

    def _split(self, piece: bytes) -> list[bytes]:
        """The words of a piece, by the file's normaliser and pattern."""
        if self._drops_space:
            if _LETTERS.fullmatch(piece):
                return [piece]
            if _ASCII.fullmatch(piece):
                return _ASCII_WORDS.findall(piece)
        text = piece.decode()
        if self._normal is not None:
            text = self._normal.normalize_str(text)
        signs = [w for w, _ in self._pre.pre_tokenize_str(text)] if self._pre is not None and text else [text]
        return [bytes(map(self._byte_of.__getitem__, s)) for s in signs]

    def _learn(self, pieces: Iterable[bytes]) -> None:
        new = self._memo.unseen(pieces)
        if self._drops_space:
            letters = list(filter(_LETTERS.fullmatch, new))  # most pieces are one word as they are
            self._memo.add(letters, self.words(letters))
            new = list(set(new).difference(letters))
        split = [self._split(p) for p in new]
        distinct = list(set().union(*split))
        ids = dict(zip(distinct, self.words(distinct)))
        self._memo.add(new, [b"".join([ids[w] for w in words]) for words in split])

    def _parts(self, text: bytes) -> list[bytes]:
        """A text cut between words into parts of about ``BATCH_BYTES``."""
        out, start = [], 0
        while self._drops_space and len(text) - start > BATCH_BYTES and (end := text.find(b" ", start + BATCH_BYTES)) >= 0:
            out.append(text[start:end])
            start = end
        return [*out, text[start:]] if out else [text]

    def _batch(self, texts: list[bytes]) -> list[bytes]:
        cut: list[list[list[bytes] | bytes]] = []  # lists of pieces, and the ids of added tokens between them
        for text in texts:
            segments = self._mark.split(text) if self._mark is not None else [text]
            cut.append([self._one[s] if i % 2 else self._cut(s) for i, s in enumerate(segments)])
        self._learn({p for segments in cut for s in segments if isinstance(s, list) for p in s})
        known = self._memo.known.__getitem__
        return [b"".join([s if isinstance(s, bytes) else b"".join(map(known, s)) for s in segments]) for segments in cut]

    def encode(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """The ids of each UTF-8 text, in order, as bytes of ``dtype``."""
        batch, held = [], 0
        for text in texts:
            if len(text) > BATCH_BYTES:
                yield from self._batch(batch)
                batch, held = [], 0
                # an added token has no space, so no cut falls into one
                yield b"".join([self._batch([part])[0] for part in self._parts(text)])
                continue
            batch.append(text)
            held += len(text)
            if held >= BATCH_BYTES:
                yield from self._batch(batch)
                batch, held = [], 0
        yield from self._batch(batch)

    def decode(self, ids: Iterable[int | None]) -> str:
        """The text of ids as the library gives it; ids that the file doesn't have are left out."""
        signs = [s for i in ids if (s := self._signs.get(i)) is not None]
        return b"".join(signs).decode("utf-8", "replace") if self._by_bytes else b" ".join(signs).decode()

    def forget(self) -> None:
        self._memo.clear()


_models: dict[str, RankBpe] = {}


def model_of(path: str) -> RankBpe:
    """One model per worker and file."""
    if path not in _models:
        _models[path] = RankBpe(path)
    return _models[path]


def encode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row: the ids of its whole text, without added special tokens.

    Strings of special tokens inside a text are those tokens, as the library
    has it by default.  Null and empty texts have no ids (an empty array), a
    null id stays null, repeated rows give a row each, and an empty table gives
    an empty result.  Other columns, whatever their names, are not read.  A text
    of any length is encoded whole, some megabytes at a time.  Nothing is shuffled,
    and a task keeps at most ``memo.MEMO_BYTES`` of words, until it ends.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(tokenizer)
        try:
            for batch in batches:
                doc_ids, held, size, first = batch.column("doc_id"), [], 0, 0
                for ids in model.encode(texts_of(batch.column("text"))):
                    held.append(ids)
                    size += len(ids)
                    if size >= BATCH_BYTES:
                        yield _id_batch(doc_ids.slice(first, len(held)), held, model.dtype)
                        held, size, first = [], 0, first + len(held)
                if held:
                    yield _id_batch(doc_ids.slice(first, len(held)), held, model.dtype)
        finally:
            model.forget()

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def _id_batch(doc_ids: pa.Array, rows: list[bytes], dtype: str) -> pa.RecordBatch:
    width = np.dtype(dtype).itemsize
    ends = np.cumsum([0, *(len(r) // width for r in rows)]).astype(np.int32)
    flat = np.frombuffer(b"".join(rows), dtype).astype(np.int32)
    return pa.record_batch([doc_ids, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "ids"])


def decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, ids, text`` for every row of token ids: their text, special tokens included.

    A file without a decoder puts a space between tokens; one of bytes joins
    them and puts U+FFFD for what is no UTF-8, both as the library does.  Null
    ids of a row give a null text, none at all an empty one; single ids that are
    null or unknown to the file are left out.  Repeated rows give a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(tokenizer)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                texts, size = [], 0
                for row in batch.column("ids").slice(start):
                    texts.append(None if not row.is_valid else model.decode(row.values.to_pylist()))
                    size += len(texts[-1] or "")
                    if size >= BATCH_BYTES:
                        break
                done = batch.slice(start, len(texts))
                yield pa.record_batch([*done.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
                start += len(texts)

    rows = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids")
    )
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, text string")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def digest(decoded: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the rows of ``decode``."""
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        _sha256(listed).alias("ids_sha256"),
        _sha256(F.col("text")).alias("decoded_sha256"),
    )
