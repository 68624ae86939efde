"""Line dedup with two Bloom filters.

A line's key is the line without white space at its ends, A-Z in lower case.  A key
held by two or more documents loses all its lines except in the document with the
smallest id.

1. Every document gives the 128-bit digests of its distinct keys, written once.
2. Digests are dealt to segments by hash, as many as hold ``SEGMENT`` digests each.
   Each segment has two Bloom filters, of fixed size: tasks send the digests that they
   saw once and twice, each one time only, and a position that two senders hit moves
   from the once-seen to the twice-seen filter.
3. A segment's digests are held against its twice-seen filter.  Only suspects, which
   are all repeats and a few others, go on.  A segment with a frequent line holds many
   digests, so it is dealt to several tasks, each with a copy of the filter.
4. Suspects are grouped by digest (with map-side combine) for exact confirmation and
   the smallest id, and every later document gets the list of digests to drop.

Filters, segments and lists are never on the driver.  Keys that a large share of the
documents holds are broadcast with their first document: at most ``HOT`` keys can
hold more than ``1 / HOT`` of the suspects.  The others are shuffled.

A digest is BLAKE2b of 128 bits: two different keys with equal digests are not to be
expected in any corpus.  A text is split whole, in one task, in about six times its bytes.

Defined results: a null or empty text is one empty line, and a null text stays null; a row with
a null id keeps all lines and makes no other document lose one; rows that repeat an
id are one document; other columns pass through, but those named ``n_lines`` or
``n_dropped`` give way; an empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline.llm.common import cut, few_or_shuffled, fresh, mix, small_batches

SPACE = b" \t\n\x0b\x0c\r"
#: digests of a segment, bits of each of its filters, positions of a digest
SEGMENT = 1 << 12
BITS = 1 << 15
HASHES = 3
#: digests that a task gathers before it sends them
GATHER = 1 << 20
#: a digest with more than this share of the suspects is hot
HOT = 1 << 12

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def line_key(line: bytes, least: int) -> bytes | None:
    """The key of a line, or None if it has under ``least`` code points."""
    key = line.strip(SPACE).lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode()) < least):
        return None
    return key


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _text(value) -> bytes:
    return bytes(value.as_buffer()) if value.is_valid else b""


def _digests(least: int):
    """Per document (key, text) its distinct digests, a row each."""

    def run(batches):
        for batch in batches:
            rows, out = [], []
            for row, value in enumerate(batch.column(1)):
                keys = {k for line in _text(value).split(b"\n") if (k := line_key(line, least)) is not None}
                out += [digest(k) for k in keys]
                rows += [row] * len(keys)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(out, pa.binary())], names=["id", "digest"])

    return run


def _halves(column) -> np.ndarray:
    """A binary column of 16 bytes a row as pairs of longs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


def _segment(halves: np.ndarray, segments: int) -> np.ndarray:
    return (mix(halves[:, 0].copy()) % np.uint64(segments)).astype(np.int64)


def _positions(second: np.ndarray) -> np.ndarray:
    """The ``HASHES`` positions in a filter for each digest's second half."""
    return (mix(second[:, None] * _ODD[:HASHES]) % np.uint64(BITS)).astype(np.int64)


def _senders(segments: int):
    """What a task saw, per segment: its number of digests, and the second halves seen
    once or more and twice or more, each listed one time."""

    def send(parts):
        halves = np.concatenate(parts)
        segment = _segment(halves, segments)
        order = np.lexsort((halves[:, 1], segment))
        segment, second = segment[order], halves[order, 1]
        first = np.ones(len(order), bool)
        first[1:] = (segment[1:] != segment[:-1]) | (second[1:] != second[:-1])
        again = np.zeros(len(order), bool)
        again[1:] = ~first[1:]
        begin = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
        end = np.append(begin[1:], len(order))
        once = [second[a:b][first[a:b]].tobytes() for a, b in zip(begin, end, strict=True)]
        twice = [np.unique(second[a:b][again[a:b]]).tobytes() for a, b in zip(begin, end, strict=True)]
        return pa.RecordBatch.from_arrays(
            [pa.array(segment[begin]), pa.array(end - begin), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["segment", "n", "once", "twice"]
        )

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            if batch.num_rows:
                parts.append(_halves(batch.column(0)))
                size += batch.num_rows
            if size >= GATHER:
                yield send(parts)
                parts, size = [], 0
        if parts:
            yield send(parts)

    return run


def _filters(key, group):
    """A segment's once-seen and twice-seen filters from all senders; the second is kept."""
    once, twice = np.zeros(BITS, bool), np.zeros(BITS, bool)
    for seen, again in zip(group.column("once").to_pylist(), group.column("twice").to_pylist(), strict=True):
        at = np.unique(_positions(np.frombuffer(seen, "<u8")))
        twice[at] |= once[at]
        once[at] = True
        twice[_positions(np.frombuffer(again, "<u8")).ravel()] = True
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "twice": pa.array([np.packbits(twice).tobytes()], pa.binary())})


def _probe(key, left, right):
    """The rows of a segment whose positions are all in the twice-seen filter."""
    out = left.select(["id", "digest"])
    if not left.num_rows or not right.num_rows:
        return out.slice(0, 0)
    twice = np.unpackbits(np.frombuffer(right.column("twice")[0].as_py(), np.uint8)).astype(bool)
    return out.filter(pa.array(twice[_positions(_halves(left.column("digest"))[:, 1])].all(axis=1)))


def suspects(found: DataFrame) -> DataFrame:
    """Of ``found(id, digest)`` the rows whose digest may be in two documents."""
    segments = max(1, -(-found.count() // SEGMENT))
    sent = cut(found.select("digest").mapInArrow(_senders(segments), "segment bigint, n bigint, once binary, twice binary"))
    filters = sent.groupBy("segment").applyInArrow(_filters, "segment bigint, twice binary")
    load = cut(sent.groupBy("segment").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * SEGMENT))
    deals = few_or_shuffled(load.select("segment", F.ceil(F.col("n") / SEGMENT).alias("deals")))

    def segment(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(_segment(_halves(batch.column(1)), segments) if batch.num_rows else [], pa.int64())], names=["id", "digest", "segment"]
            )

    dealt = found.mapInArrow(segment, StructType([*found.schema.fields, *StructType.fromDDL("segment bigint").fields]))
    left = dealt.join(deals, "segment", "left").withColumn("deal", F.pmod(F.xxhash64("id"), F.coalesce("deals", F.lit(1))))
    right = filters.join(deals, "segment", "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("deals", F.lit(1)) - 1)))
    both = left.select("id", "digest", "segment", "deal").groupBy("segment", "deal").cogroup(right.groupBy("segment", "deal"))
    return both.applyInArrow(_probe, found.schema)


def repeats(suspect: DataFrame) -> DataFrame:
    """``(id, digest)`` of every document that holds a key which one with a smaller id holds too."""
    owners = cut(suspect.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n")).where("first < last"))
    hot = owners.where(F.col("n") > F.lit(max(1000, suspect.count() // HOT)))  # at most HOT rows
    hot = F.broadcast(hot.select("digest", F.col("first").alias("hot_first")))
    near = suspect.join(hot, "digest", "left")
    rest = near.where("hot_first is null").select("id", "digest").join(owners.select("digest", "first"), "digest")
    return near.where("id > hot_first").select("id", "digest").unionByName(rest.where("id > first").select("id", "digest"))


def _keep(columns: int, least: int):
    """Replace the text (first column) by its kept lines; the last column lists digests to drop."""

    def run(batches):
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for value, gone in zip(batch.column(0), batch.column(columns - 1).to_pylist(), strict=True):
                text = _text(value)
                if not gone:
                    n_lines.append(text.count(b"\n") + 1)
                    n_dropped.append(0)
                    texts.append(text.decode() if value.is_valid else None)
                    continue
                gone, lines = set(gone), text.split(b"\n")
                kept = [line for line in lines if (k := line_key(line, least)) is None or digest(k) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                texts.append(b"\n".join(kept).decode())
            arrays = [pa.array(texts, pa.string()), *batch.columns[1:-1], pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])

    return run


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 10) -> DataFrame:
    """``docs`` with ``text`` cut to the lines that stay, ``n_lines`` before and
    ``n_dropped``."""
    small_batches(docs.sparkSession)
    docs = docs.drop(*(c for c in ("n_lines", "n_dropped") if c not in (text, key)))
    names = docs.columns
    docs = docs.select(text, *(c for c in names if c != text))
    keyed = docs.where(F.col(key).isNotNull())
    id_field = StructField("id", docs.schema[key].dataType)
    schema = StructType([id_field, *StructType.fromDDL("digest binary").fields])
    found = cut(keyed.select(key, text).mapInArrow(_digests(least), schema))
    gone = repeats(cut(suspects(found)))
    gone_id, drop = fresh(names, "gone_id"), fresh(names, "gone_digests")
    lists = cut(gone.groupBy(F.col("id").alias(gone_id)).agg(F.collect_set("digest").alias(drop)))
    joined = keyed.join(lists, keyed[key] == lists[gone_id], "left").drop(gone_id)
    alone = docs.where(F.col(key).isNull()).withColumn(drop, F.lit(None).cast("array<binary>"))
    out = StructType([*docs.schema.fields, *StructType.fromDDL("n_lines bigint, n_dropped bigint").fields])
    return joined.unionByName(alone).mapInArrow(_keep(len(names) + 1, least), out).select(*names, "n_lines", "n_dropped")
