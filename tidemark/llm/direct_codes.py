"""Token ids in files of directly addressable codes.

An id is cut into chunks of eight bits.  The first chunks of all ids of a shard
stand next to each other, then the second chunks of those ids that have one,
and so on.  A bitmap per level says which ids go on, and a rank directory how
many do so before every 512th, so that the place of an id's next chunk, and
with it any single token, is found without decoding anything else.

A file set is a folder with two Parquet tables: ``shards`` (``part, shard,
local_start, n_ids, codes, doc_ids, doc_lengths``) and ``parts`` (``part,
base``, the number of ids in all parts before).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ordering import with_position
from tidemark.functions.sizes import small_side
from tidemark.llm.frames import id_text, part_bases
from tidemark.llm.tokens import BATCH_BYTES, encoder, texts_of
from tidemark.workspace import materialise

MAGIC = b"TDAC1\0\0\0"
RANK_BITS = 512
SHARD_IDS = 1 << 20
# Ranges of documents for each shuffle partition, and keys sampled to cut one.
RANGES_PER_PARTITION = 2
SAMPLES_PER_RANGE = 50

_SHARDS = (
    "part int, shard int, local_start bigint, n_ids bigint, codes binary,"
    " doc_ids array<bigint>, doc_lengths array<bigint>"
)


def encode(ids: np.ndarray) -> bytes:
    """The codes of unsigned ids: magic, number of levels, then each level.

    A level is its number of chunks, its chunks, and, but for the last one, its
    bitmap and rank directory.
    """
    rest, levels = ids, []
    while True:
        more = rest > 255
        level = struct.pack("<Q", len(rest)) + (rest & 255).astype(np.uint8).tobytes()
        last = not more.any()
        if not last:
            ends = np.arange(0, len(rest), RANK_BITS)
            ranks = np.concatenate(([0], np.add.reduceat(more, ends, dtype=np.int64).cumsum()[:-1]))
            level += np.packbits(more, bitorder="little").tobytes() + ranks.astype("<u4").tobytes()
        levels.append(level)
        if last:
            return MAGIC + struct.pack("<Q", len(levels)) + b"".join(levels)
        rest = rest[more] >> 8


class Codes:
    """Reads codes: any token by its place, or all of them."""

    def __init__(self, raw: bytes) -> None:
        if raw[:8] != MAGIC:
            raise ValueError("these are no directly addressable codes")
        (n_levels,) = struct.unpack_from("<Q", raw, 8)
        at, self.levels = 16, []
        for level in range(n_levels):
            (n,) = struct.unpack_from("<Q", raw, at)
            chunks = np.frombuffer(raw, np.uint8, n, at + 8)
            at += 8 + n
            bitmap, ranks = None, None
            if level < n_levels - 1:
                bitmap = np.frombuffer(raw, np.uint8, -(-n // 8), at)
                at += len(bitmap)
                ranks = np.frombuffer(raw, "<u4", -(-n // RANK_BITS), at)
                at += 4 * len(ranks)
            self.levels.append((chunks, bitmap, ranks))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, place: int) -> int:
        """The id at ``place``: one chunk, and one rank, for each level it has."""
        if not 0 <= place < len(self):
            raise IndexError(place)
        value = 0
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            value |= int(chunks[place]) << 8 * level
            if bitmap is None or not bitmap[place >> 3] >> (place & 7) & 1:
                return value
            first = place // RANK_BITS * RANK_BITS
            before = np.unpackbits(bitmap[first >> 3 : (place >> 3) + 1], bitorder="little")[: place - first]
            place = int(ranks[place // RANK_BITS]) + int(before.sum())
        return value

    def ids(self) -> np.ndarray:
        """All ids, as little-endian unsigned 32-bit numbers."""
        out, where = None, None
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            values = chunks.astype("<u4") << np.uint32(8 * level)
            if out is None:
                out, where = values, np.arange(len(values))
            else:
                out[where] |= values
            if bitmap is not None:
                where = where[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)]
        return out


_KEYS = ("doc_id", "h", "tie")
_ENCODED = "doc_id bigint, h bigint, tie bigint, range int"


def _range_bounds(keys: DataFrame, n: int) -> tuple[DataFrame, int]:
    """Key tuples that cut the rows into about ``n`` even ranges, by a sample of ``SAMPLES_PER_RANGE`` for each."""
    rows = keys.agg(F.count(F.lit(1))).first()[0]
    sampled = keys.sample(fraction=min(1.0, n * SAMPLES_PER_RANGE / max(1, rows)), seed=11)
    spread = sampled.repartitionByRange(n, *_KEYS).groupBy(F.spark_partition_id().alias("p"))
    tops = spread.agg(F.max(F.struct(*_KEYS)).alias("k")).select("k.*")
    bounds = materialise(tops.distinct(), "range-bounds")
    return bounds, bounds.count()


def _with_ids(rows: pa.RecordBatch, ids: list[bytes], width: int) -> pa.RecordBatch:
    names = [x.split()[0] for x in _ENCODED.split(", ")]
    widths = pa.array(np.full(len(ids), width, np.int32))
    return pa.record_batch([*(rows.column(c) for c in names), pa.array(ids, pa.binary()), widths], [*names, "ids", "width"])


def write_codes(
    df: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of every row of ``df`` to a file set at ``path``, in ascending order of the id column.

    Null ids come first; rows with equal ids follow the hash of their texts.
    Null and empty texts have the end id alone; an empty table gives an empty
    file set; other columns are not read.

    Texts are encoded where they are read.  Their ids, about a third as large,
    are dealt by ranges of the order; ranges are cut by a sample of the keys,
    and equal rows by a third key that differs for each, so no task gets a hot
    source, id or group.
    """
    spark = df.sparkSession
    text_hash, tie = F.xxhash64("text").alias("h"), F.xxhash64(F.monotonically_increasing_id()).alias("tie")
    rows = id_text(df, id_col, text_col).select("doc_id", "text", text_hash, tie)
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, n_bounds = _range_bounds(rows.select(*_KEYS), ranges)
    placed = with_position(rows, _KEYS, bounds, n_bounds, "range")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(tokenizer, lengths=False)
        width = np.dtype(model.kind).itemsize
        end = b"" if end_id is None else end_id.to_bytes(width, "little")
        try:
            for batch in batches:
                first, held, size = 0, [], 0
                for ids in model(texts_of(batch.column("text"))):
                    held.append(ids + end)
                    size += len(ids)
                    if size >= BATCH_BYTES:
                        yield _with_ids(batch.slice(first, len(held)), held, width)
                        first, held, size = first + len(held), [], 0
                if held:
                    yield _with_ids(batch.slice(first, len(held)), held, width)
        finally:
            model.forget()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, part, shard, first = [], 0, None, 0, 0

        def put() -> pa.RecordBatch:
            raw, width = b"".join(r[1] for r in held), held[0][2]
            ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4")
            row = [part, shard, first, len(ids), encode(ids), [r[0] for r in held], [len(r[1]) // width for r in held]]
            return pa.record_batch([pa.array([x], t) for x, t in zip(row, types)], names)

        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [x.split()[0] for x in _SHARDS.split(", ")]
        for batch in batches:
            for doc_id, ids, width, of in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "width", "range"))):
                n = len(ids) // width
                if held and (of != part or size + n > SHARD_IDS):
                    yield put()
                    shard, first = (shard + 1, first + size) if of == part else (0, 0)
                    held, size = [], 0
                part = of
                held.append((doc_id, ids, width))
                size += n
        if held:
            yield put()

    ids = placed.mapInArrow(encoded, f"{_ENCODED}, ids binary, width int")
    ordered = ids.repartition("range").sortWithinPartitions("range", *_KEYS)
    ordered.mapInArrow(shards, _SHARDS).write.parquet(f"{path}/shards")
    written = df.sparkSession.read.schema(_SHARDS).parquet(f"{path}/shards")
    part_bases(written, "part", "n_ids").write.parquet(f"{path}/parts")


def _placed(spark: SparkSession, path: str) -> DataFrame:
    written = spark.read.schema(_SHARDS).parquet(f"{path}/shards")
    bases = spark.read.schema("part int, base bigint").parquet(f"{path}/parts")
    return written.join(small_side(bases), "part").withColumn("begin", F.col("base") + F.col("local_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document of the file set at ``path``.

    ``start`` counts the ids of all documents before it; the checksum is over
    its decoded ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, begin, doc_ids, lengths in zip(
                *(batch.column(c) for c in ("codes", "begin", "doc_ids", "doc_lengths"))
            ):
                ids, sizes = memoryview(Codes(codes.as_py()).ids()), lengths.values.to_numpy()
                ends = sizes.cumsum()
                starts = ends - sizes
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch(
                    [doc_ids.values, pa.array(starts + begin.as_py()), pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    columns = _placed(spark, path).select("codes", "begin", "doc_ids", "doc_lengths")
    return columns.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def tokens_at(spark: SparkSession, path: str, places: list[int]) -> DataFrame:
    """``place, token`` for the given places among all ids; places beyond the end give no row.

    Only the shards that hold a place are read in full, and of them only what
    the directory points to.
    """
    wanted = F.array(*[F.lit(int(p)).cast("bigint") for p in dict.fromkeys(places)]) if places else F.array().cast("array<bigint>")
    found = _placed(spark, path).select(
        "codes", "begin",
        F.filter(wanted, lambda p: (p >= F.col("begin")) & (p < F.col("begin") + F.col("n_ids"))).alias("places"),
    ).where(F.size("places") > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for codes, begin, held in zip(*(batch.column(c).to_pylist() for c in ("codes", "begin", "places"))):
                read = Codes(codes)
                yield pa.record_batch(
                    [pa.array(held, pa.int64()), pa.array([read[p - begin] for p in held], pa.int64())],
                    ["place", "token"],
                )

    return found.mapInArrow(run, "place bigint, token bigint")
