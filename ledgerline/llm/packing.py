"""Tokenize whole texts and pack them best-fit under vector capacities.

``encode`` turns texts into token ids and cuts long ones into pieces; ``pack``
puts pieces into sequences so that tokens, pieces and attention cost (sum of
squared lengths) stay within capacity.

A piece's demand follows from its length alone, so packing works on the histogram
of lengths, which has at most ``capacity`` rows whatever the input: lengths in
decreasing order go into the group of equally filled sequences that scores best
by residual norm or by weighted dot product.  One placement covers as many pieces
as the length or the group has, so the plan has a few thousand rows at any size.
Spark then ranks the pieces of each length (by shard, so that a frequent length
is spread) and looks up every rank's place in the plan.

Defined results: a null or empty text is the end token alone; repeated rows are
packed each; ties in rank go by key and piece, then in any order; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, giving_back, prefix_hash, range_hash, small_batches, text_chunks

SEQUENCE = 1024
END_ID = 2
#: words that a task remembers the ids of
CACHE_WORDS = 200_000
#: pieces that one shard ranks
SHARD_ROWS = 50_000
SPECIAL = b"<|endoftext|>"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: lead bytes of characters that may be white space beyond ASCII
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


class ByteBpe:
    """Byte-level BPE ids of whole texts, the same as the ``tokenizers`` file gives.

    The pattern that cuts words never joins a character to white space after it, so
    a text is encoded word by word (white space first); equal words are encoded once.
    A text with the special token's string goes through ``tokenizers`` itself.
    """

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path = json_path
        self._whole = None
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int, int] = {}
        self.starts = np.zeros(1 << 16, np.int64)
        self.sizes = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def whole(self, text: str) -> list[int]:
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.json_path)
        return self._whole.encode(text, add_special_tokens=False).ids

    def _learn(self, words: list[bytes], hashes: list[int]) -> None:
        ids = [self.encoding.encode_ordinary(w.decode("utf-8")) for w in words]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first, total = len(self.known), int(sizes.sum())
        while len(self.starts) < first + len(ids):
            self.starts, self.sizes = (np.concatenate((x, np.zeros_like(x))) for x in (self.starts, self.sizes))
        while len(self.flat) < self.used + total:
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        self.sizes[first : first + len(ids)] = sizes
        self.starts[first : first + len(ids)] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used : self.used + total] = np.fromiter((i for x in ids for i in x), np.int32, total)
        self.used += total
        self.known.update(zip(hashes, range(first, first + len(ids)), strict=True))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk and the end of each text's ids."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        space = _SPACE[data]
        # a character's last byte that may end wide white space: no cut after it
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        wide = np.zeros(len(data), bool)
        wide[np.concatenate((lead[1:], [len(data)]))[_WIDE[data[lead]]] - 1] = True
        new = np.zeros(len(data), bool)
        new[1:] = space[1:] & ~space[:-1] & ~wide[:-1]
        new[offsets[:-1][offsets[:-1] < len(data)]] = True
        start = np.flatnonzero(new)
        end = np.concatenate((start[1:], [len(data)]))
        word = range_hash(prefix_hash(data, folded=False), start, end)
        distinct, first, inverse = np.unique(word, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_WORDS:
            self._clear()
        keys = distinct.tolist()
        new_at = [i for i, h in enumerate(keys) if h not in self.known]
        if new_at:
            raw = data.tobytes()
            at = first[new_at]
            self._learn([raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)], [keys[i] for i in new_at])
        place = np.fromiter(map(self.known.__getitem__, keys), np.int64, len(keys))[inverse]
        sizes = self.sizes[place]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[place] - (ends - sizes), sizes) + np.arange(ends[-1])]
        words_before = np.searchsorted(start, offsets[1:])
        return ids, np.concatenate(([0], ends))[words_before]


def public_byte_bpe() -> ByteBpe:
    import public_tokenizers as p

    return ByteBpe(p.path("byte_bpe_50k.json"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer=public_byte_bpe, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids)``: ids as little-endian unsigned 32-bit.
    Only texts of more than ``size`` ids are cut; their first piece takes the rest."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = source.schema["doc_id"].simpleString().split(":", 1)[1]

    def run(batches):
        bpe = tokenizer()
        names = ["doc_id", "piece", "start", "length", "ids"]
        for batch in batches:
            for at, _, data, offsets in text_chunks(batch.column(1)):
                ids, ends = bpe.encode(data, offsets)
                ids = ids.astype("<u4")
                raw = data.tobytes()
                odd = SPECIAL in raw
                rows, pieces, starts, lengths, parts = [], [], [], [], []
                lo = 0
                for r, hi in enumerate(ends.tolist()):
                    own = ids[lo:hi]
                    lo = hi
                    if odd and SPECIAL in raw[offsets[r] : offsets[r + 1]]:
                        own = np.array(bpe.whole(raw[offsets[r] : offsets[r + 1]].decode("utf-8")), "<u4")
                    own = np.append(own, np.uint32(end_id)).astype("<u4").tobytes()
                    n = len(own) // 4
                    cuts = [0, *range(n % size or size, n + 1, size)] if n > size else [0, n]
                    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        rows.append(at + r)
                        pieces.append(i)
                        starts.append(a)
                        lengths.append(b - a)
                        parts.append(own[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())],
                    names=names,
                )

    return source.mapInArrow(giving_back(run), f"doc_id {schema}, piece int, start bigint, length bigint, ids binary")


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds: tokens, pieces, and the sum of squared piece lengths."""

    tokens: int = SEQUENCE
    pieces: int = SEQUENCE
    cost: int = SEQUENCE * SEQUENCE


def place(histogram: dict[int, int], capacity: Capacity, weights=(1.0, 1e-3, 1e-3), by: str = "norm") -> tuple[list[tuple], int]:
    """Rows ``(length, first rank, end rank, first sequence, offset)`` and the number of
    sequences.  Piece ``first rank + i`` of that length goes to ``first sequence + i``.

    Lengths go in decreasing order, each to the group of equally filled sequences
    that leaves the smallest weighted residual norm (``by="norm"``) or has the
    largest weighted dot product of demand and residual (``by="dot"``), under every
    capacity; if none has room, new sequences are opened.
    """
    full = np.array([capacity.tokens, capacity.pieces, capacity.cost], float)
    w = np.array(weights, float)
    rows: list[tuple] = []
    # groups of equally filled sequences: residuals, number, first sequence
    rest = np.zeros((0, 3))
    groups: list[list[int]] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], float)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens is over capacity")
        left, rank = histogram[length], 0
        while left:
            fits = np.flatnonzero((rest >= need).all(axis=1)) if len(rest) else []
            if len(fits):
                if by == "norm":
                    points = -(w * ((rest[fits] - need) / full) ** 2).sum(axis=1)
                else:
                    points = (w * (rest[fits] / full) * (need / full)).sum(axis=1)
                g = int(fits[np.argmax(points)])
                n, first = groups[g]
                take = min(n, left)
                offset = int(capacity.tokens - rest[g][0])
                if take < n:
                    groups[g] = [n - take, first + take]
                    rest = np.vstack((rest, rest[g] - need))
                    groups.append([take, first])
                else:
                    rest[g] -= need
            else:
                per = int(min(full // need))
                take = min(left, -(-left // per))
                first, offset = opened, 0
                opened += take
                rest = np.vstack((rest, full - need))
                groups.append([take, first])
            rows.append((length, rank, rank + take, first, offset))
            rank += take
            left -= take
        open_ = rest[:, 0] > 0
        if not open_.all():
            rest, groups = rest[open_], [g for g, o in zip(groups, open_, strict=True) if o]
    return rows, opened


#: weights of tokens, pieces and cost that ``pack`` tries with both scores
WEIGHTS = ((1.0, 1e-3, 1e-3), (1.0, 1.0, 1e-3), (1.0, 1e-3, 1.0), (1.0, 1.0, 1.0), (1e-3, 1.0, 1e-3))


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), order=("doc_id", "piece"), weights=WEIGHTS) -> DataFrame:
    """``pieces`` (with a ``length``) and their ``sequence_id`` and ``offset``.

    The score and weights that need the fewest sequences are taken.  The histogram, at most one row per
    length, is all that reaches the driver; the plan is broadcast, a few rows per
    length."""
    pieces = cut(pieces.drop("sequence_id", "offset"))
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    spark = pieces.sparkSession
    rows, _ = min((place(histogram, capacity, w, by) for by in ("norm", "dot") for w in weights), key=lambda x: x[1])
    plan = spark.createDataFrame(rows, "length bigint, lo bigint, hi bigint, first bigint, offset bigint")
    shards = sum(histogram.values()) // SHARD_ROWS + 1
    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64(*order), F.lit(shards)))
    # rank within a length: the shard's offset plus the place in the shard
    sizes = dealt.groupBy("length", "_shard").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_shard")) - F.col("_n")
    sizes = cut(sizes.select("length", "_shard", before.alias("_before")))
    place_ = F.row_number().over(Window.partitionBy("_shard", "length").orderBy(*order)) - 1
    ranked = dealt.withColumn("_place", place_).join(sizes, ["length", "_shard"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_place"))
    p, q = ranked.alias("p"), F.broadcast(plan).alias("q")
    found = p.join(q, (F.col("p.length") == F.col("q.length")) & (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi")))
    return found.select("p.*", (F.col("first") + F.col("_rank") - F.col("lo")).alias("sequence_id"), F.col("q.offset").alias("offset")).select(
        *pieces.columns, "sequence_id", "offset"
    )
