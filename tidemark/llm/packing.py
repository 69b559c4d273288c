"""Packing by concatenation: all documents end to end, cut into windows of equal length.

Two passes over token totals give every document its place: each task adds up
its own documents as it encodes them, then the totals of the tasks are added
up.  A window that reaches from one run of documents into the next leaves a
boundary record on either side; only those meet in a shuffle.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import id_text, with_base
from tidemark.llm.tokens import TOKEN_ROWS, token_rows
from tidemark.workspace import materialise

BATCH_PIECES = 50_000
BATCH_IDS = 4 << 20


def wide(ids: bytes, width: int) -> np.ndarray:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.frombuffer(ids, "<u2" if width == 2 else "<u4").astype("<u4", copy=False)


@dataclass
class Packed:
    """Encoded documents and where each begins in the row of all documents."""

    placed: DataFrame
    length: int

    def pieces(self) -> DataFrame:
        """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece.

        Every id of every document lies in exactly one piece, and the pieces of
        a sequence fill it without gaps from 0.
        """
        size = self.length

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = _Columns("doc_id start length ids_crc32 doc_tokens sequence_id offset")
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "begin", "n_tokens", "ids", "width"))
                for doc_id, begin, n, raw, width in zip(*columns):
                    ids, start = memoryview(wide(raw, width)), 0
                    while start < n:
                        window, offset = divmod(begin + start, size)
                        length = min(size - offset, n - start)
                        crc = zlib.crc32(ids[start : start + length])
                        out.add(doc_id, start, length, crc, n, window, offset)
                        start += length
                if len(out) >= BATCH_PIECES:
                    yield out.take()
            yield out.take()

        return self.placed.mapInArrow(
            cut,
            "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint,"
            " sequence_id bigint, offset bigint",
        )

    def sequences(self, pad_id: int = 0) -> DataFrame:
        """``sequence_id, ids, n_ids``: the windows, the last one padded with ``pad_id``.

        A last window whose length is a power of two stays as it is.  Windows
        that one task holds whole never leave it.
        """
        size = self.length

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, at = np.empty(0, "<u4"), 0  # ids not put out yet, and the place of the first
            for batch in batches:
                out = []
                for begin, raw, width in zip(*(batch.column(c).to_pylist() for c in ("begin", "ids", "width"))):
                    if begin != at + len(held):
                        out += _windows(held, at, size, True)[0]
                        held, at = np.empty(0, "<u4"), begin
                    held = np.concatenate((held, wide(raw, width)))
                    if len(held) >= size:
                        rows, held, at = _windows(held, at, size, False)
                        out += rows
                yield _window_batch(out)
            yield _window_batch(_windows(held, at, size, True)[0])

        parts = self.placed.mapInArrow(cut, "sequence_id bigint, offset int, ids array<bigint>")
        parts = materialise(parts, "windows")
        whole = F.size("ids") == size
        joined = (
            parts.where(~whole)
            .groupBy("sequence_id")  # at most one window of ids, whatever the number of records
            .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
        )
        n = F.size("ids")
        full = (n == size) | (F.bit_count(n) == 1)
        padding = F.array_repeat(F.lit(pad_id).cast("bigint"), F.lit(size) - n)
        return parts.where(whole).select("sequence_id", "ids").unionByName(joined).select(
            "sequence_id", F.when(full, F.col("ids")).otherwise(F.concat("ids", padding)).alias("ids"), n.alias("n_ids")
        )


class _Columns:
    """Rows of whole numbers, gathered by column."""

    def __init__(self, names: str) -> None:
        self.names = names.split()
        self.rows: list[tuple] = []

    def __len__(self) -> int:
        return len(self.rows)

    def add(self, *row: int | None) -> None:
        self.rows.append(row)

    def take(self) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [[] for _ in self.names]
        out = pa.record_batch([pa.array(list(c), pa.int64()) for c in columns], self.names)
        self.rows = []
        return out


def _windows(ids: np.ndarray, at: int, size: int, rest: bool) -> tuple[list[tuple], np.ndarray, int]:
    """Windows that end within ``ids``, which begin at place ``at``; with ``rest`` also what is left."""
    out = []
    while len(ids):
        window, offset = divmod(at, size)
        n = size - offset
        if len(ids) < n and not rest:
            break
        out.append((window, offset, ids[:n]))
        at += min(n, len(ids))
        ids = ids[n:]
    return out, ids, at


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2].astype(np.int64) for r in rows], pa.list_(pa.int64())),
        ],
        ["sequence_id", "offset", "ids"],
    )


def pack(
    df: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Packed:
    """Encode every row of ``df``, end it with ``end_id`` and place it behind the rows before it.

    Rows are placed in the order in which tasks read them.  Null and empty texts
    have the end id alone (without an end id they have no piece); a null id
    stays null; repeated rows are packed as often as they come; an empty table
    gives no pieces; other columns are not read.  Only the last sequence can be
    short.  Texts are encoded once, in place; the ids are written to the shared
    folder, and neither texts nor ids are shuffled but for boundary records.
    """
    rows = id_text(df, id_col, text_col).mapInArrow(token_rows(tokenizer, end_id), TOKEN_ROWS)
    table = materialise(rows, "packed-ids")
    placed = with_base(table, "part", "n_tokens")
    begin = (F.col("base") + F.col("local_start")).alias("begin")
    return Packed(placed.select("doc_id", begin, "n_tokens", "ids", "width"), length)
