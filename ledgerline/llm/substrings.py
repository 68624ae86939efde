"""Repeated byte windows across documents, by depth-limited radix sort of suffixes.

The suffixes of all texts are ordered only through their first ``length`` bytes,
most significant digit first.  After a pass only groups that still hold suffixes
of two documents (or of two different runs) go on, with a longer digit; equal
groups after the last digit are exactly the repeated windows.

To keep the first digits cheap, suffixes are handled in runs.  A window's first
digit is the gram of ``GRAM`` bytes with the smallest hash inside it, its anchor;
the windows that share an anchor lie side by side and form one run, so one record
stands for about sixteen suffixes.  Equal windows have equal anchors at equal
places, which keeps the passes exact:

1. anchor gram (20 bytes): a run whose gram occurs in one document only is done.
2. the whole run, and the gram with the 15 bytes before or after it (35 bytes): a
   run that occurs in an earlier document is removed whole; of the others, kept by
   their first document, those that share 35 bytes with a different run go on.
3. the full window (50 bytes) of each suffix in such runs.

Documents are dealt into parts of about ``PART_BYTES``.  A part combines equal
records of its documents before the shuffle, so a passage that a third of all
documents share costs one record a part, and a record is a few bytes in a binary
row; answers come back as one byte per record.  The text is shuffled once: every
pass reads the same exchange.

Defined results: null text counts as empty; a text shorter than ``length`` bytes
has no window; repeated rows of one key are one document for matching (they never
match each other) and each gets its row; ties go to the smallest key; rows with a
null key match nothing and stay whole.  Other columns pass through, those named as
a result column give way.  An empty table gives an empty result.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerline.llm.common import CHUNK_BYTES, give_back, mix, prefix_hash, range_hash, small_batches, text_chunks

LENGTH = 50
GRAM = 20
#: text bytes of one part and of one bucket; both counts follow the input.  A part sends a
#: message to every bucket until it has fewer records than there are buckets, so a bucket
#: is as large as one task holds with ease; mixed codes fill all alike
PART_BYTES = 1 << 20
BUCKET_BYTES = 8 << 20

_MESSAGE = "part bigint, bucket bigint, step int, data binary"
_NAMES = ["part", "bucket", "step", "data"]
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
_RESULT = "n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def _planes(x: np.ndarray) -> bytes:
    """Bytes of 64-bit values by significance: the zero bytes of small values then compress away."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def _slide(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size, m = 1, v
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


class _Runs:
    """The runs of windows of a chunk: anchor place, first and last window start, row, gram hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
        self.prefix = prefix_hash(data, folded=False)
        n = len(data)
        self.length, self.gram = length, gram
        z = np.zeros(0, np.int64)
        self.anchor = self.first = self.last = self.row = z
        self.code = np.zeros(0, np.uint64)
        if n < length:
            return
        at = np.arange(n - gram + 1, dtype=np.int64)
        code = range_hash(self.prefix, at, at + gram)
        bits = np.uint64(max(22, int(n).bit_length()))
        v = ((code >> bits) << bits) | at.astype(np.uint64)
        low = _slide(v, length - gram + 1)
        anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        # window starts inside one document only
        valid = np.ones(n - length + 1, bool)
        for edge in offsets[1:-1]:
            valid[max(0, edge - length + 1) : edge] = False
        new = np.empty(len(valid), bool)
        new[0] = True
        new[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(valid)])) - 1
        ok = valid[first]
        self.first, self.last = first[ok], last[ok]
        self.anchor = anchor[self.first]
        self.row = np.searchsorted(offsets, self.first, "right") - 1
        # an anchor has the least hash of its window: mixed again, the codes are even
        self.code = mix(code[self.anchor])

    def keep(self, mask: np.ndarray) -> None:
        for name in ("anchor", "first", "last", "row", "code"):
            setattr(self, name, getattr(self, name)[mask])

    def content(self) -> np.ndarray:
        return range_hash(self.prefix, self.first, self.last + self.length)

    def side(self, left: bool) -> np.ndarray:
        """Hash of the gram with the bytes before or after it, 0 where no window has all of them."""
        half = (self.length - self.gram + 1) // 2
        out = np.zeros(len(self.anchor), np.uint64)
        if left:
            ok = self.first <= self.anchor - half
            a = self.anchor[ok]
            out[ok] = range_hash(self.prefix, a - half, a + self.gram)
        else:
            ok = self.last >= self.anchor - half
            a = self.anchor[ok]
            out[ok] = range_hash(self.prefix, a, a + self.length - half)
        return out

    def starts(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window starts of the runs on the chosen sides of the anchor, and the run of each."""
        half = (self.length - self.gram + 1) // 2
        lo = np.where(left, self.first, np.maximum(self.first, self.anchor - half))
        hi = np.where(right, self.last, np.minimum(self.last, self.anchor - half))
        n = np.where(left | right, np.maximum(hi - lo + 1, 0), 0)
        run = np.repeat(np.arange(len(n)), n)
        return lo[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n), run


class _Part:
    """What every pass computes from the texts of a part, the same way each time."""

    def __init__(self, table: pa.Table, key: str, text: str, length: int, gram: int, buckets: int):
        keys = table.column(key).combine_chunks()
        self.null = np.asarray(keys.is_null())
        self.keys = np.asarray(keys.cast(pa.int64()).fill_null(0))
        self.text = table.column(text)
        self.length, self.gram, self.buckets = length, gram, buckets
        self._kept = None

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, _Runs]]:
        """The runs of a chunk; a single long text comes in pieces that overlap by a window."""
        if len(offsets) > 2 or len(data) <= 2 * CHUNK_BYTES:
            yield 0, _Runs(data, offsets, self.length, self.gram)
            return
        for at in range(0, len(data) - self.length + 1, CHUNK_BYTES):
            piece = data[at : at + CHUNK_BYTES + self.length - 1]
            yield at, _Runs(piece, np.array([0, len(piece)]), self.length, self.gram)

    def chunks(self) -> Iterator[tuple[int, _Runs]]:
        for first, _, _, _, runs in self.all_runs():
            yield first, runs

    def all_runs(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, _Runs]]:
        """``(first row, bytes, offsets, shift, runs)`` of every piece.  A pass goes over
        them several times, so those of a part of usual size are kept."""
        if self._kept is not None:
            for *place, runs in self._kept:
                yield *place, copy.copy(runs)
            return
        kept = [] if self.text.nbytes <= 4 * PART_BYTES else None
        for first, _, data, offsets in text_chunks(self.text):
            for shift, runs in self.pieces(data, offsets):
                runs.keep(~self.null[runs.row + first])
                if kept is not None:
                    kept.append((first, data, offsets, shift, runs))
                yield first, data, offsets, shift, copy.copy(runs)
        self._kept = kept

    def bucket(self, code: np.ndarray) -> np.ndarray:
        return ((code >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchor grams in order, and whether two documents of the part hold each."""
        codes, keys = [], []
        for first, runs in self.chunks():
            codes.append(runs.code)
            keys.append(self.keys[runs.row + first])
        code, key = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((codes, np.uint64), (keys, np.int64)))
        order = np.argsort(code, kind="stable")
        code, key = code[order], key[order]
        start = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else np.zeros(0, np.int64)
        if not len(start):
            return code, np.zeros(0, bool)
        return code[start], np.minimum.reduceat(key, start) != np.maximum.reduceat(key, start)

    def shared_runs(self, repeated: np.ndarray):
        """Distinct (gram, run) records on repeated grams, in order, with the smallest document."""
        rows = []
        for first, runs in self.chunks():
            runs.keep(_member(repeated, runs.code))
            rows.append((runs.code, runs.content(), runs.side(True), runs.side(False), self.keys[runs.row + first]))
        code, content, left, right, key = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.uint64),) * 4 + (np.zeros(0, np.int64),)
        order = np.lexsort((key, content, code))
        code, content, left, right, key = (x[order] for x in (code, content, left, right, key))
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (content[1:] != content[:-1])
        return code[new], content[new], left[new], right[new], key[new]

    def windows(self, repeated: np.ndarray, content: np.ndarray, key: np.ndarray, state: np.ndarray):
        """Distinct full windows of undecided runs, in order, with the smallest document.
        ``content`` is sorted; a run belongs to its first document only."""
        hashes, keys = [], []
        for first, runs in self.chunks():
            runs.keep(_member(repeated, runs.code))
            at = np.searchsorted(content, runs.content())
            own = self.keys[runs.row + first]
            open_ = (state[at] & 1 == 0) & (state[at] & 6 != 0) & (own == key[at])
            runs.keep(open_)
            at, own = at[open_], own[open_]
            starts, run = runs.starts(state[at] & 2 != 0, state[at] & 4 != 0)
            hashes.append(range_hash(runs.prefix, starts, starts + self.length))
            keys.append(own[run])
        h, k = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((hashes, np.uint64), (keys, np.int64)))
        order = np.lexsort((k, h))
        h, k = h[order], k[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        return h[new], k[new]


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def _send(part: _Part, number: int, step: int, code: np.ndarray, pack) -> pa.Table:
    """One message per bucket: the records of that bucket, in order of their code."""
    bucket = part.bucket(code).astype(np.int64)
    edge = np.flatnonzero(np.diff(bucket)) + 1
    lo, hi = np.concatenate(([0], edge)), np.concatenate((edge, [len(code)]))
    if not len(code):
        lo = hi = np.zeros(0, np.int64)
    return pa.table(
        [
            pa.array(np.full(len(lo), number, np.int64)),
            pa.array(bucket[lo] if len(lo) else lo),
            pa.array(np.full(len(lo), step, np.int32)),
            pa.array([pack(a, b) for a, b in zip(lo, hi, strict=True)], pa.binary()),
        ],
        names=_NAMES,
    )


def _answers(table: pa.Table, step: int) -> np.ndarray:
    """The answers to a part's records of one step, in the order in which they were sent."""
    rows = [(b, d) for b, s, d in zip(*(table.column(c).to_pylist() for c in ("bucket", "step", "data")), strict=True) if s == step]
    return np.frombuffer(b"".join(d for _, d in sorted(rows)), np.uint8)


def _split(table: pa.Table) -> tuple[list[int], list[bytes]]:
    return table.column("part").to_pylist(), table.column("data").to_pylist()


def _reply(table: pa.Table, step: int, sizes: list[int], answer: np.ndarray) -> pa.Table:
    ends = np.cumsum(sizes)
    data = [answer[e - s : e].astype(np.uint8).tobytes() for s, e in zip(sizes, ends, strict=True)]
    return pa.table([table.column("part"), table.column("bucket"), pa.array(np.full(len(sizes), step, np.int32)), pa.array(data, pa.binary())], names=_NAMES)


def _group(values: np.ndarray) -> np.ndarray:
    """Number of equal values for each of ``values``."""
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    return count[inverse]


def _first_digit(table: pa.Table) -> pa.Table:
    """Is the gram in two documents?  A record is 4 bytes of the gram and a flag."""
    raw = [np.frombuffer(d, np.uint8).reshape(-1, 5) for d in _split(table)[1]]
    every = np.concatenate(raw)
    gram = np.ascontiguousarray(every[:, :4]).view(np.uint32).ravel()
    _, inverse, count = np.unique(gram, return_inverse=True, return_counts=True)
    both = count + np.bincount(inverse, weights=every[:, 4]).astype(np.int64)
    return _reply(table, 1, [len(r) for r in raw], (both > 1)[inverse])


def _second_digit(table: pa.Table) -> pa.Table:
    """1: an earlier document holds the run; 2, 4: another run shares 35 bytes on that side."""
    sizes, parts = [], [[], [], [], []]
    for d in _split(table)[1]:
        n = len(d) // 24
        sizes.append(n)
        parts[0].append(np.frombuffer(d, np.uint64, n))
        parts[1].append(np.frombuffer(d, np.uint32, n, 8 * n))
        parts[2].append(np.frombuffer(d, np.uint32, n, 12 * n))
        parts[3].append(_from_planes(d[16 * n :]))
    content, left, right, key = (np.concatenate(p) for p in parts)
    order = np.lexsort((key, content))
    new = np.ones(len(order), bool)
    new[1:] = content[order][1:] != content[order][:-1]
    group = np.cumsum(new) - 1
    least = key[order][new]
    earlier = np.empty(len(order), bool)
    earlier[order] = key[order] > least[group]
    one = order[new]  # one record per different run
    answer = earlier.astype(np.uint8)
    for bit, side in ((2, left), (4, right)):
        shared = np.zeros(len(order), bool)
        shared[order] = ((_group(side[one]) > 1) & (side[one] != 0))[group]
        answer |= np.where(shared, bit, 0).astype(np.uint8)
    return _reply(table, 2, sizes, answer)


def _last_digit(table: pa.Table) -> pa.Table:
    """Does an earlier document hold the window?"""
    sizes, hashes, keys = [], [], []
    for d in _split(table)[1]:
        n = len(d) // 16
        sizes.append(n)
        hashes.append(np.frombuffer(d, np.uint64, n))
        keys.append(_from_planes(d[8 * n :]))
    h, k = np.concatenate(hashes), np.concatenate(keys)
    order = np.lexsort((k, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    earlier = np.empty(len(order), bool)
    earlier[order] = k[order] > k[order][new][np.cumsum(new) - 1]
    return _reply(table, 3, sizes, earlier)


def _undecided(part: _Part, answers: pa.Table):
    """The repeated grams, and the part's runs by content with key and state."""
    code, _ = part.grams()
    repeated = code[_answers(answers, 1) != 0]
    _, content, _, _, key = part.shared_runs(repeated)
    state = _answers(answers, 2)
    order = np.argsort(content, kind="stable")
    return repeated, content[order], key[order], state[order]


def _part_functions(key: str, text: str, length: int, buckets: int, n_columns: int):
    """The function of each pass over a part's texts and the answers so far."""
    gram = min(GRAM, length)
    none = pa.table([pa.array([], t) for t in _TYPES], names=_NAMES)

    def load(table: pa.Table) -> tuple[int, _Part]:
        return table.column("part")[0].as_py(), _Part(table, key, text, length, gram, buckets)

    def first(table: pa.Table) -> pa.Table:
        number, p = load(table)
        code, multi = p.grams()
        rec = np.empty((len(code), 5), np.uint8)
        rec[:, :4] = (code & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.uint8).reshape(-1, 4)
        rec[:, 4] = multi
        return _send(p, number, 1, code, lambda a, b: rec[a:b].tobytes())

    def second(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return none
        number, p = load(table)
        code, _ = p.grams()
        c, content, left, right, k = p.shared_runs(code[_answers(answers, 1) != 0])
        left, right = ((x >> np.uint64(32)).astype(np.uint32) for x in (left, right))
        return _send(p, number, 2, c, lambda a, b: b"".join((content[a:b].tobytes(), left[a:b].tobytes(), right[a:b].tobytes(), _planes(k[a:b]))))

    def third(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return none
        number, p = load(table)
        h, k = p.windows(*_undecided(p, answers))
        return _send(p, number, 3, h, lambda a, b: b"".join((h[a:b].tobytes(), _planes(k[a:b]))))

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        columns = [f"c{i}" for i in range(n_columns)]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        sizes, spans, kept = [], [], []
        if table.num_rows:
            _, p = load(table)
            for data, offsets, removed in _removed(p, answers, length):
                for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                    m = removed[lo:hi]
                    step = np.flatnonzero(np.diff(m.astype(np.int8), prepend=0, append=0))
                    sizes.append(hi - lo)
                    spans.append([{"start": a, "end": b} for a, b in step.reshape(-1, 2).tolist()])
                    kept.append(data[lo:hi][~m].tobytes())
        added = [pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
        return pa.table([table.column(c) for c in columns] + added, names=[*columns, "n_bytes", "spans", "kept"])

    return tuple(map(_freeing, (first, second, third, finish)))


def _freeing(fn):
    """``fn`` of a group's tables, which gives back what it allocated."""

    def of_group(table: pa.Table) -> pa.Table:
        try:
            return fn(table)
        finally:
            give_back()

    def of_both(table: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return fn(table, answers)
        finally:
            give_back()

    return of_group if fn.__code__.co_argcount == 1 else of_both


def _removed(p: _Part, answers: pa.Table, length: int):
    """Per chunk of the part's texts: its bytes, row offsets, and the bytes to remove."""
    repeated, content, owner, state = _undecided(p, answers)
    h, k = p.windows(repeated, content, owner, state)
    gone = _answers(answers, 3)
    mark = last = None
    for at, data, offsets, shift, runs in p.all_runs():
        if last is None or data is not last[0]:
            if last is not None:
                yield *last, np.cumsum(mark)[:-1] > 0
            last, mark = (data, offsets), np.zeros(len(data) + 1, np.int32)
        runs.keep(_member(repeated, runs.code))
        if not len(runs.row):
            continue
        where = np.searchsorted(content, runs.content())
        mine = p.keys[runs.row + at]
        whole = (state[where] & 1 != 0) | (mine != owner[where])
        np.add.at(mark, shift + runs.first[whole], 1)
        np.add.at(mark, shift + runs.last[whole] + length, -1)
        rest = ~whole & (state[where] & 6 != 0)
        runs.keep(rest)
        mine, st = mine[rest], state[where][rest]
        starts, run = runs.starts(st & 2 != 0, st & 4 != 0)
        if len(starts):
            w = np.searchsorted(h, range_hash(runs.prefix, starts, starts + length))
            hit = (gone[w] != 0) | (mine[run] != k[w])
            np.add.at(mark, shift + starts[hit], 1)
            np.add.at(mark, shift + starts[hit] + length, -1)
    if last is not None:
        yield *last, np.cumsum(mark)[:-1] > 0


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` (the maximal byte runs covered by windows of
    ``length`` bytes that also start in a document with a smaller key) and ``kept``
    (the remaining bytes)."""
    small_batches(docs.sparkSession)
    names = [c for c in docs.columns if c not in ("n_bytes", "spans", "kept") or c in (key, text)]
    docs = docs.select(*(F.col(f"`{c}`") for c in names))
    total = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    n_parts, buckets = total // PART_BYTES + 1, total // BUCKET_BYTES + 1
    # rows without a key match nothing: they stay whole and are not dealt, so that no
    # part holds them all; another row's part follows from its key, so every pass deals it alike
    keyed, others = docs.where(F.col(f"`{key}`").isNotNull()), docs.where(F.col(f"`{key}`").isNull())
    part = F.pmod(F.xxhash64(key), F.lit(n_parts))
    dealt = keyed.select(part.alias("part"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)))
    ckey, ctext = (f"c{names.index(c)}" for c in (key, text))
    first, second, third, finish = _part_functions(ckey, ctext, length, buckets, len(names))

    # every pass groups the same frame, so Spark shuffles the text once and reuses it
    texts = lambda: dealt.groupBy("part")
    told = texts().applyInArrow(first, _MESSAGE).groupBy("bucket").applyInArrow(_freeing(_first_digit), _MESSAGE)
    for step, digit in ((second, _second_digit), (third, _last_digit)):
        asked = texts().cogroup(told.groupBy("part")).applyInArrow(step, _MESSAGE)
        told = told.unionByName(asked.groupBy("bucket").applyInArrow(_freeing(digit), _MESSAGE))
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)] + StructType.fromDDL(_RESULT).fields)
    out = texts().cogroup(told.groupBy("part")).applyInArrow(finish, schema)
    out = out.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(names)), "n_bytes", "spans", "kept")
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    values = {"n_bytes": F.octet_length(whole), "spans": F.array(), "kept": whole}
    added = [values[f.name].cast(f.dataType).alias(f.name) for f in StructType.fromDDL(_RESULT).fields]
    return out.unionByName(others.select(*(F.col(f"`{c}`") for c in names), *added))
