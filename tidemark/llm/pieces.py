"""SentencePiece encoding and decoding as a weighted transducer.

The transducer is compiled from a model: its normaliser (escaped spaces, the
prefix), its pieces, and bytes for characters that have none.  Composed with a
text it has an arc for each piece at each place.  For a BPE model a step from
one piece to the next weighs nothing if merging the two alone leaves them
apart, and is infinite if it doesn't: merges left and right of a boundary
don't depend on each other as long as it stands, so just one path has a finite
weight, and it is what the merges give.  The search for the shortest path in
the tropical semiring may thus stop at the first whole path.  ``lattice``
composes all distinct chunks of a batch at once; the few long ones are searched
one by one here.
"""

from __future__ import annotations

import codecs
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from tidemark.functions.ordering import col
from tidemark.llm.frames import id_text
from tidemark.llm.lattice import Lattice
from tidemark.llm.tokens import Encoder, texts_of

# SentencePiece's escaped space, and its types of models and pieces.
SPACE = "▁"
BPE = 2
NORMAL, BYTE, USER_DEFINED = 1, 6, 4

# Chunks up to this length are composed together.
LANE_CHARS = 64
STEP_MEMO = 300_000
# More than other encoders keep: a chunk that is not remembered costs a search.
CHUNK_MEMO_BYTES = 192 << 20
_BREAK = "\0"
_EACH_BYTE = "tidemark-each-byte"
codecs.register_error(_EACH_BYTE, lambda e: ("\ufffd" * (e.end - e.start), e.end))


class Transducer:
    """The compiled model; encodes and decodes single texts."""

    def __init__(self, path: str) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        form, kinds = model.normalizer_spec, {p.type for p in model.pieces}
        if model.trainer_spec.model_type != BPE or not model.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are compiled")
        if form.precompiled_charsmap or USER_DEFINED in kinds or not form.escape_whitespaces:
            raise ValueError("character maps, user-defined pieces and unescaped spaces are not compiled")
        if model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("spaces as suffixes are not compiled")
        self.prefix, self.squeeze = form.add_dummy_prefix, form.remove_extra_whitespaces
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.reach: dict[str, int] = {}  # the length of the longest piece, by its first two characters
        for piece in self.ids:
            self.reach[piece[:2]] = max(len(piece), self.reach.get(piece[:2], 1))
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.output = [
            bytes([int(p.piece[1:-1], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode() if p.type == NORMAL else b""
            for p in model.pieces
        ]
        self.steps: dict[tuple[str, str], bool] = {}
        self._compile_breaks()

    def _compile_breaks(self) -> None:
        """Where no piece reaches across: before spaces, around line ends, between a letter and a mark."""
        pairs = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.spaces_break = all(a == SPACE for a, b in pairs if b == SPACE)
        self.lines_break = not any("\n" in p for p in pairs)
        # Letters as the pattern below has them, which holds signs such as a raised two.
        joined = {m: {a for a, b in pairs if b == m and re.match(r"[^\W\d_]", a)} for m in ".,!?;:"}
        open_marks = [m for m in joined if not any(map(str.isalpha, joined[m]))]
        marks = "".join(map(re.escape, open_marks))
        other = "".join(re.escape(a) for a in sorted(set().union(*(joined[m] for m in open_marks))))
        self.marks = re.compile(f"[{marks}](?<=[^\\W\\d_{other}][{marks}])") if marks else None

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        return (" " + text if self.prefix and text else text).replace(" ", SPACE)

    def chunks(self, text: str) -> list[str]:
        """The normalised text in parts that no piece reaches across."""
        text = self.normalise(text)
        if not self.spaces_break or _BREAK in text:
            return [text]
        if self.marks is not None:
            text = self.marks.sub(_BREAK + r"\g<0>", text)
        if self.lines_break:
            text = text.replace("\n", f"{_BREAK}\n{_BREAK}")
        if SPACE + SPACE in text:
            text = re.sub(f"{SPACE}+", _BREAK + r"\g<0>", text)
        else:
            text = text.replace(SPACE, _BREAK + SPACE)
        return text.split(_BREAK)

    def merged(self, text: str) -> list[str]:
        """What merging by score leaves of a few characters."""
        symbols, scores = list(text), self.scores
        while len(symbols) > 1:
            best = max(
                ((scores[s], -i) for i, s in enumerate(map(str.__add__, symbols, symbols[1:])) if s in scores), default=None
            )
            if best is None:
                break
            i = -best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        return symbols

    def step(self, left: str, right: str) -> bool:
        """Whether the weight of a step between two arcs is finite."""
        known = self.steps.get((left, right))
        if known is None:
            if len(self.steps) > STEP_MEMO:
                self.steps.clear()
            known = self.steps[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return known

    def path(self, chunk: str) -> list[str]:
        """The inputs of the arcs of the shortest path, longer arcs tried first."""
        n, ids, reach, step = len(chunk), self.ids, self.reach, self.steps
        trail, at, left, size, dead = [], 0, "", min(n, reach.get(chunk[:2], 1)), set()
        while at < n:
            while size:
                piece = chunk[at : at + size]
                if (piece in ids or size == 1) and (at + size, piece) not in dead:
                    known = step.get((left, piece))
                    if known if known is not None else self.step(left, piece):
                        break
                size -= 1
            if size:
                trail.append(piece)
                at, left = at + size, piece
                size = min(n - at, reach.get(chunk[at : at + 2], 1))
            else:  # no way on from here: the arc that led here is dead
                dead.add((at, left))
                trail.pop()
                at, size, left = at - len(left), len(left) - 1, trail[-1] if trail else ""
        return trail

    def encode_chunk(self, chunk: str) -> list[int]:
        out = []
        for piece in self.path(chunk):
            found = self.ids.get(piece)
            if found is None:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(found)
        return out

    def encode(self, text: str) -> list[int]:
        return [i for chunk in self.chunks(text) for i in self.encode_chunk(chunk)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; bytes that make up no character become U+FFFD each."""
        raw = b"".join(map(self.output.__getitem__, ids))
        if self.prefix and raw.startswith(b" ") and ids[0] != self.bytes[0x20]:  # that byte is a space of the text itself
            raw = raw[1:]
        return raw.decode(errors=_EACH_BYTE)


class PieceEncoder(Encoder):
    """Encodes texts with a transducer, remembering the parts it has met."""

    def __init__(self, path: str) -> None:
        self._begin(lengths=False, memo_bytes=CHUNK_MEMO_BYTES)
        self.transducer = Transducer(path)
        self.cut, self.kind = self.transducer.chunks, "H" if len(self.transducer.output) <= 1 << 16 else "I"
        try:
            self.lattice = Lattice(self.transducer.scores, self.transducer.ids)
        except ValueError:  # merges don't follow from scores alone; chunks are searched one by one
            self.lattice = None
        self._ids = lambda chunks: list(map(self.transducer.encode_chunk, chunks))

    def _encode(self, texts: list[str]) -> list[int | bytes]:
        """Chunks of common lengths all at once, longer ones, which would leave the others waiting, one by one."""
        if self.lattice is None:
            return super()._encode(texts)
        short = [t for t in texts if len(t) <= LANE_CHARS]
        done = iter(self.lattice.encode(short, "<u2" if self.kind == "H" else "<u4", self.transducer.bytes))
        return [next(done) if len(t) <= LANE_CHARS else super(PieceEncoder, self)._encode([t])[0] for t in texts]

    def _cut_long(self, text: bytes) -> Iterator[bytes]:
        parts = super()._cut_long(text) if self.transducer.spaces_break and not self.transducer.squeeze else iter([text])
        yield next(parts)
        for part in parts:  # its space is the prefix that a text of its own gets
            yield part[1:] if self.transducer.prefix else part


_encoders: dict[str, PieceEncoder] = {}


def piece_encoder(path: str) -> PieceEncoder:
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def _encoded(model: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, ids, text`` for batches of ``doc_id, text``, in small batches."""
    encode = piece_encoder(model)
    for batch in batches:
        at, out = 0, []
        for ids in encode(texts_of(batch.column("text"))):
            out.append(np.frombuffer(ids, "<u2" if encode.kind == "H" else "<u4").astype(np.int32))
            if len(out) == 500 or at + len(out) == batch.num_rows:
                ids_column = pa.array(out, pa.list_(pa.int32()))
                rows = batch.slice(at, len(out))
                yield pa.record_batch([rows.column("doc_id"), ids_column, rows.column("text")], ["doc_id", "ids", "text"])
                at, out = at + len(out), []


def _decoded(model: str, ids: pa.Array) -> pa.Array:
    decode = piece_encoder(model).transducer.decode
    return pa.array((decode(row.values.to_numpy().tolist()) for row in ids), pa.string())


def encode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` for every row of ``df``: the ids of its whole text, without begin or end.

    Null and empty texts have no ids; null ids stay null; repeated rows come out
    as often as they go in; an empty table gives an empty result; other columns
    are not read.  Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encoded(model, batches):
            yield batch.select(["doc_id", "ids"])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode_pieces(df: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` for every row of ``df``: the text that its ids stand for.

    Null and empty lists give an empty text, null ids within a list nothing.
    """
    rows = df.select(
        col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.filter(col(ids_col), lambda i: i.isNotNull()), F.array().cast("array<int>")).alias("ids"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column("doc_id"), _decoded(model, batch.column("ids"))], ["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id bigint, text string")


def checked_pieces(df: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_crc32, round_trip`` for every row of ``df``, encoded and decoded in one task.

    The checksum is over the ids as little-endian unsigned 32-bit numbers;
    ``round_trip`` says whether decoding them gives the text again, which a text
    with the escaped space itself doesn't.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _encoded(model, batches):
            ids = batch.column("ids")
            crcs = [zlib.crc32(row.values.to_numpy().astype("<u4")) for row in ids]
            same = pc.equal(_decoded(model, ids), batch.column("text").cast(pa.string()))
            yield pa.record_batch(
                [batch.column("doc_id"), pc.cast(pc.list_value_length(ids), pa.int64()), pa.array(crcs, pa.int64()), same],
                ["doc_id", "n_tokens", "ids_crc32", "round_trip"],
            )

    return id_text(df, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, round_trip boolean"
    )
