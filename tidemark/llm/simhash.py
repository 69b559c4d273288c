"""SimHash fingerprints, and groups of documents whose fingerprints are close.

Fingerprints are cut into blocks.  Two that differ in at most ``distance`` bits
agree in all but ``distance`` of the blocks, so they share at least one set of
``blocks - distance`` equal blocks: pairs are sought among those that share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.functions.ordering import col
from tidemark.llm.components import components
from tidemark.llm.frames import hot_chunks, id_text, unused_name
from tidemark.workspace import materialise

SEED = 42
CHUNK = 256

# Row x: the eight bits of byte x, one in each byte of a 64-bit number.
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def fingerprint(text: bytes, words: int) -> int:
    """The 64-bit SimHash of the word shingles of ``text`` (UTF-8), repeats counted."""
    found = text.lower().split()  # of bytes: A-Z only, and the six ASCII white space characters
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        hashes = np.array([xxh64_intdigest(joined, SEED)], dtype="<u8")
    else:
        ends = np.fromiter(map(len, found), np.int64, len(found))
        ends += 1
        ends = ends.cumsum()
        starts = [0, *ends[:-words].tolist()]
        hashes = np.array(
            [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist())], dtype="<u8"
        )
    counts, lanes = np.zeros(64, np.int64), hashes.view(np.uint8).reshape(-1, 8)
    for at in range(0, len(lanes), 255):  # so many ones fit a byte
        counts += _SPREAD[lanes[at : at + 255]].sum(axis=0).view(np.uint8)
    bits = counts * 2 > len(hashes)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, digest, bits`` per row: a hash of the whole text, and its fingerprint as a signed 64-bit number.

    Null texts are empty; texts without words have fingerprint zero.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            bits = np.fromiter((fingerprint(x.as_py(), words) for x in text), np.uint64, len(text))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("digest"), pa.array(bits.view(np.int64))],
                ["doc_id", "digest", "bits"],
            )

    rows = id_text(df, id_col, text_col).withColumn("digest", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id bigint, digest bigint, bits bigint")


def block_masks(blocks: int, distance: int) -> list[int]:
    """A mask for each set of ``blocks - distance`` of ``blocks`` blocks of the 64 bits."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    single = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    masks = (sum(chosen) for chosen in combinations(single, blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _stars(group: np.ndarray, bits: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(member, head)`` that connect what is close within each run of equal ``group``."""
    n = len(bits)
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, n)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)  # rows left in the run, this one included
    head, at, found = np.arange(n), np.arange(n), []
    for step in range(1, n):
        at = at[left[at] > step]
        if not len(at):
            break
        close = np.bitwise_count(bits[at] ^ bits[at + step]) <= distance
        if close.any():
            found.append(np.stack((at[close], at[close] + step)))
    if not found:
        return bits[:0], bits[:0]
    a, b = np.concatenate(found, axis=1)
    while True:
        least = np.minimum(head[a], head[b])
        before = head.copy()
        np.minimum.at(head, a, least)
        np.minimum.at(head, b, least)
        head = head[head]
        if np.array_equal(before, head):
            break
    linked = np.flatnonzero(head != np.arange(n))
    return bits[linked], bits[head[linked]]


def close_links(distinct: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Links ``a, b`` that connect what ``bits`` within ``distance`` of each other connect.

    ``distinct`` holds each fingerprint once.  Keys that only one fingerprint
    has are dropped by a count; what shares a key is compared in groups of
    at most about ``2 * CHUNK``: a larger key is dealt into chunks and every
    pair of chunks is a group, so none is left out.  A group puts out no more
    links than it has rows, whatever the number of close pairs.  Both sides of
    the join of keys to their counts have a row per fingerprint and mask, which
    Spark takes for one per fingerprint: so it is told to merge them.
    """
    masks = F.array(*[F.lit(m) for m in block_masks(blocks, distance)])
    keyed = distinct.select("bits", F.posexplode(masks).alias("which", "mask")).select(
        "bits", F.xxhash64("which", F.col("bits").bitwiseAND(F.col("mask"))).alias("key")
    )
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    chunks = hot_chunks(F.col("n"), CHUNK)
    mine = F.pmod(F.xxhash64("bits", F.lit(1)), chunks).cast("int")
    members = (
        keyed.join(shared.hint("merge"), "key")
        .select("key", "bits", mine.alias("mine"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .select("bits", F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("grp"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bits = np.empty(0, np.int64), np.empty(0, np.uint64)

        def links(n: int) -> pa.RecordBatch:
            a, b = _stars(group[:n], bits[:n], distance)
            return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            group = np.concatenate((group, batch.column("grp").to_numpy()))
            bits = np.concatenate((bits, batch.column("bits").to_numpy().view(np.uint64)))
            whole = int(np.searchsorted(group, group[-1])) if len(group) else 0  # the last run may go on
            if whole:
                yield links(whole)
                group, bits = group[whole:], bits[whole:]
        if len(group):
            yield links(len(group))

    return members.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, "a bigint, b bigint")


def fingerprint_groups(printed: DataFrame, distance: int = 4, blocks: int = 7) -> DataFrame:
    """``bits, root, component_id`` for each distinct fingerprint of ``printed`` (``doc_id, bits``).

    ``root`` is the same for all fingerprints of a group, and ``component_id``
    the smallest doc_id of the group's documents, null only if all are null.
    """
    distinct = materialise(printed.groupBy("bits").agg(F.min("doc_id").alias("least")), "fingerprints")
    links = materialise(close_links(distinct.select("bits"), distance, blocks).distinct(), "fingerprint-links")
    roots = components(links)
    rooted = distinct.join(roots, distinct["bits"] == roots["node"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    # a table of its own, so that the rows of a very large group can be split over tasks
    heads = materialise(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "group-heads")
    return rooted.select("bits", "root").join(heads, "root")


def near_duplicates(
    df: DataFrame,
    words: int = 4,
    distance: int = 4,
    blocks: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, digest, bits, fingerprint, root, component_id`` for every row of ``df``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked;
    a group is what links connect.  Null and empty texts have fingerprint zero
    and are linked like any other.  Rows with a null id are grouped by their
    text and keep the null; repeated rows come out as often as they go in; an
    empty table gives an empty result; other columns are not read.  Exact
    copies share a fingerprint and are compared once.
    """
    printed = materialise(fingerprints(df, words, id_col, text_col), "printed")
    groups = fingerprint_groups(printed, distance, blocks)
    joined = printed.join(groups, "bits")
    name = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return joined.select("doc_id", "digest", "bits", name.alias("fingerprint"), "root", "component_id")


def keep_one(
    df: DataFrame,
    words: int = 4,
    distance: int = 4,
    blocks: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``df``, with all their columns, that are the first of their group of near duplicates.

    Of each group the row with the smallest id stays; if several rows have that
    id, one of them by the hash of its text.  Rows with a null id come after all
    others of their group.
    """
    near = near_duplicates(df, words, distance, blocks, id_col, text_col)
    heads = near.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "doc_id", "digest").count()
    kept = materialise(
        heads.groupBy("root").agg(F.min(F.struct("digest", "doc_id", "count")).alias("head")).select("head.*"), "kept-heads"
    )
    head_id, head_digest = (unused_name(df, f"head_{c}") for c in ("id", "digest"))
    rows = df.withColumns(
        {head_id: col(id_col).cast("bigint"), head_digest: F.xxhash64(F.coalesce(col(text_col).cast("string"), F.lit("")))}
    )

    def chosen(heads: DataFrame) -> DataFrame:
        on = rows[head_id].eqNullSafe(heads["doc_id"]) & (rows[head_digest] == heads["digest"])
        return rows.join(heads, on, "left_semi")

    repeated = kept.where("count > 1")
    out = chosen(kept.where("count = 1"))
    if not repeated.isEmpty():
        out = out.unionByName(chosen(repeated).dropDuplicates([head_id, head_digest]))
    return out.drop(head_id, head_digest)
