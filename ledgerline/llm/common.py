"""Helpers shared by the corpus operators: lineage cuts, word hashing on Arrow
batches, and distributed connected components."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text that one numpy step handles; a longer single text is handled alone
CHUNK_BYTES = 1 << 20
#: rows of an Arrow batch that holds texts; Spark's default of 10,000 is tens of MB on both sides
BATCH_ROWS = 1000
#: ids that a join may broadcast; more are shuffled
BROADCAST_IDS = 1 << 20

_U = np.uint64
_M1, _M2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20240229)
#: a random 64-bit value per byte; A-Z share the values of a-z in the folded table
BYTE_HASH = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
BYTE_HASH_FOLDED = BYTE_HASH.copy()
BYTE_HASH_FOLDED[65:91] = BYTE_HASH[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SHINGLE_C = _rng.integers(1, 1 << 63, 16, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in ``spark.checkpoint.dir``, which driver and
    executors share.  Only a local master without that setting (tests) gets a folder
    of its own; a cluster without it raises."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="ledgerline-test-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS``, unless the session sets a number of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library returns memory in its own way
    _trim = None


def give_back() -> None:
    """Return the memory of freed arrays to the system: a Python worker lives on for
    other tasks, and what its allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def giving_back(run):
    """The Arrow iterator function ``run``, with ``give_back`` at the end of a task."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def few_or_shuffled(ids: DataFrame, limit: int = BROADCAST_IDS) -> DataFrame:
    """A column of ids for a join: broadcast if it was counted to be at most ``limit``
    (8 MB of longs), else left for Spark to shuffle."""
    ids = cut(ids)
    return F.broadcast(ids) if ids.limit(limit + 1).count() <= limit else ids


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(30))
    x *= _M1
    x ^= x >> _U(27)
    x *= _M2
    return x ^ (x >> _U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the rolling base and of its inverse modulo 2**64."""
    if len(_powers.get("b", ())) < n:
        for key, base in (("b", _BASE), ("i", _BASE_INV)):
            p = np.full(max(n, CHUNK_BYTES), base, np.uint64)
            p[0] = 1
            _powers[key] = np.multiply.accumulate(p)
    return _powers["b"][:n], _powers["i"][:n]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, end row, bytes, offsets)`` for runs of rows of a string
    column; a run has at most ``limit`` bytes unless one text is longer.  Null
    texts count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_utf8())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:  # a null may still cover bytes
        size = np.diff(offsets) * ~np.asarray(column.is_null())
        if size.sum() != offsets[-1] - offsets[0]:
            column = column.fill_null("")
            yield from text_chunks(column, limit)
            return
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (run of bytes other than the six ASCII white spaces)."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    word = ~_SPACE[data]
    before = np.empty(len(data) + 1, bool)
    before[0] = before[-1] = False
    before[1:-1] = word[:-1]
    edge = offsets[(offsets < len(data)) & (offsets >= 0)]
    before[edge] = False
    after = np.empty(len(data), bool)
    after[:-1] = word[1:]
    after[-1] = False
    inner = edge[edge > 0]
    after[inner - 1] = False
    starts = np.flatnonzero(word & ~before[:-1])
    ends = np.flatnonzero(word & ~after) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def prefix_hash(data: np.ndarray, folded: bool) -> np.ndarray:
    """Prefix sums from which the hash of any byte range follows, see ``range_hash``."""
    b, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((BYTE_HASH_FOLDED if folded else BYTE_HASH)[data] * b[: len(data)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, the same wherever the range lies."""
    _, inv = powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inv[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray, folded: bool = True):
    """``word_spans`` and a 64-bit hash per word."""
    starts, ends, rows = word_spans(data, offsets)
    return starts, ends, rows, range_hash(prefix_hash(data, folded), starts, ends)


def windows(hashes: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` words inside one row, and the index of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(rows[:n] == rows[width - 1 :])
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out += hashes[i : n + i] * _SHINGLE_C[i]
    return mix(out[first]), first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its ``width``-word shingles; a row with
    fewer words has its whole sequence as one, a row without words none."""
    _, _, rows, hashes = word_hashes(data, offsets)
    shingles, first = windows(hashes, rows, width)
    n = len(offsets) - 1
    words = np.bincount(rows, minlength=n)
    at = np.searchsorted(rows[first], np.arange(n + 1)) if len(first) else np.zeros(n + 1, np.int64)
    word_at = np.concatenate(([0], np.cumsum(words)))
    out = []
    for r in range(n):
        if words[r] >= width:
            out.append(np.unique(shingles[at[r] : at[r + 1]]))
        elif words[r]:
            h = hashes[word_at[r] : word_at[r + 1]]
            out.append(mix((h * _SHINGLE_C[: len(h)]).sum(keepdims=True) + _SHINGLE_C[8 + len(h) % 8]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def components(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of an undirected graph ``edges(a, b)`` of longs, as
    ``(id, component_id)`` with the smallest id reachable; vertices without an
    edge are absent.

    Alternating large-star and small-star steps: each keeps the number of edges
    at most the same, takes a logarithmic number of rounds, and needs grouping
    with map-side combine and a join only, so no group is ever held in memory.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for _ in range(rounds):
        # done when every vertex has one smaller neighbour, which has none itself
        least = cut(e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("k")))
        if least.where("k > 1").isEmpty() and e.join(least.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            break
        # small star: a vertex points itself and its smaller neighbours at the smallest
        pair = lambda a, b: F.struct(F.col(a).alias("u"), F.col(b).alias("v"))
        small = e.join(least, "u").select(F.explode(F.array(pair("u", "m"), pair("v", "m"))).alias("x")).select("x.u", "x.v")
        small = cut(small.where("u <> v").distinct())
        # large star: a vertex points its larger neighbours at its smallest
        both = small.unionByName(small.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        e = cut(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(roots)


def fresh(names, wanted: str) -> str:
    """A column name that none of ``names`` has, whatever its case."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def map_text(df: DataFrame, text: str, fn, fields: str, limit: int = CHUNK_BYTES) -> DataFrame:
    """Append columns that ``fn(bytes, offsets)`` computes from a string column.

    ``fn`` gets a run of rows as one byte array with row offsets and returns one
    array or list per field of the DDL string ``fields``, a value per row.  Rows
    stream through in Arrow batches; every other column passes untouched.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(df.sparkSession)
    added = StructType.fromDDL(fields)
    types = [f.type for f in to_arrow_schema(added)]
    schema = StructType(df.schema.fields + added.fields)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = [[] for _ in types]
            for _, _, data, offsets in text_chunks(batch.column(batch.schema.get_field_index(text)), limit):
                for part, kind, values in zip(parts, types, fn(data, offsets), strict=True):
                    part.append(values if isinstance(values, pa.Array) else pa.array(values, kind))
            columns = [pa.concat_arrays([p.cast(kind) for p in part]) for part, kind in zip(parts, types, strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns + columns, names=batch.schema.names + added.names)

    return df.mapInArrow(giving_back(run), schema)
