"""Periodic runs of words by descending-LCP Kruskal.

The suffixes of a text's words are sorted by prefix doubling, and the longest
common prefixes (LCP) of neighbours in that order are the edges of a path.  The
edges are taken by decreasing LCP, as Kruskal does; each unites two classes of
suffixes in a union-find whose classes keep their positions in order, the smaller
class going into the larger.  Two positions ``i < j`` that become neighbours
within a class at LCP ``l`` have exactly ``l`` words in common, so the words
``i .. j + l`` have period ``j - i`` where that is at most ``l``: a seed, and a
whole run if the word before it breaks the period.

Every run of period ``q`` and at least ``2 * q`` words is found once, by its first
word ``s``: ``s`` and ``s + q`` meet at their LCP, and a position between them in
their class would give the run a smaller period.

A run of ``times`` periods and ``least`` words makes suffixes share some number of
words at least (16 for 3 and 24).  Texts in which no window of that many words
occurs twice have no run, and the LCPs below it are not taken.

A text is handled whole in one task; texts are independent, so nothing is shuffled.
Memory is about 12 bytes a word and doubling round (at most ``log2(words)``), and
only for a text with such a repeated window; other texts take 40 bytes a word.

Defined results: a null or empty text has no words and no runs and keeps the text
''; repeated rows get their own rows; a null key is passed to ``arrange`` as
None; other columns pass through, but those named ``n_words``, ``runs`` or
``collapsed`` give way; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ledgerline.llm.common import giving_back, mix, powers, range_hash, small_batches

ADDED = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def shared_words(least: int, times: int) -> int:
    """Words that the suffixes at a run's start and one period later share at least."""
    return min(max((times - 1) * q, least - q) for q in range(1, least + 1))


def repeats_window(ids: np.ndarray, width: int) -> bool:
    """Whether a window of ``width`` words occurs twice (by 64-bit hash, so that a
    collision only costs time)."""
    n = len(ids) - width + 1
    if n < 2:
        return False
    prefix = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * powers(len(ids) + 1)[0][: len(ids)], out=prefix[1:])
    window = np.sort(range_hash(prefix, np.arange(n), np.arange(width, width + n)))
    return bool((window[1:] == window[:-1]).any())


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the LCP of each with the next one."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, step = [], 1
    while True:
        levels.append(rank.astype(np.int32))
        key = rank * (n + 1)
        key[: max(n - step, 0)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        step *= 2
        if rank[order[-1]] == n - 1:
            break
    lcp = np.zeros(n - 1, np.int64)
    a, b = order[:-1], order[1:]
    for level in reversed(range(len(levels))):
        step, at = 1 << level, levels[level]
        fits = np.flatnonzero(np.maximum(a, b) + lcp + step <= n)
        # both prefixes of this length lie inside the text, so equal ranks are equal words
        same = fits[at[a[fits] + lcp[fits]] == at[b[fits] + lcp[fits]]]
        lcp[same] += step
    return order, lcp


def find_runs(ids: np.ndarray, least: int = 24, times: int = 3) -> list[tuple[int, int, int]]:
    """Maximal runs ``(start, length, smallest period)`` of at least ``least`` words
    and ``times`` (2 or more) periods, by start and period."""
    floor = shared_words(least, times)
    if not repeats_window(ids, floor):
        return []
    order, lcp = suffix_order(ids)
    edges = np.flatnonzero(lcp >= floor)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    at, word = order.tolist(), ids.tolist()
    up: dict[int, int] = {}
    held: dict[int, list[int]] = {}

    def top(x):
        while (y := up.get(x, x)) != x:
            up[x] = x = up.get(y, y)
        return x

    runs = []

    def seed(i, j, shared):
        d = j - i
        if d * (times - 1) <= shared and d + shared >= least and (i == 0 or word[i - 1] != word[j - 1]):
            runs.append((i, d + shared, d))

    for edge, shared in zip(edges.tolist(), lcp[edges].tolist(), strict=True):
        x, y = top(edge), top(edge + 1)
        few, many = held.pop(x, None) or [at[x]], held.pop(y, None) or [at[y]]
        if len(few) > len(many):
            few, many, x, y = many, few, y, x
        up[x] = y
        # new neighbours: one position of each class with none of either between
        last = -1
        for k, position in enumerate(few):
            place = bisect_left(many, position)
            if place and many[place - 1] > last:
                seed(many[place - 1], position, shared)
            if place < len(many) and (k + 1 == len(few) or few[k + 1] > many[place]):
                seed(position, many[place], shared)
            last = position
        if many[-1] < few[0]:
            many.extend(few)
        else:
            for position in few:
                insort(many, position)
        held[y] = many
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words outside of runs and each run's first period, joined by one space."""
    if runs:
        change = np.zeros(len(words) + 1, np.int64)
        for start, length, period in runs:
            change[start + period] += 1
            change[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, text: str = "text", key: str = "doc_id", least: int = 24, times: int = 3, arrange=None) -> DataFrame:
    """``docs`` with ``n_words``, the ``runs`` of its words by start and period, and
    the text ``collapsed`` to each run's first period.

    Words are stretches of bytes other than the six ASCII white spaces.
    ``arrange(key, n_words)`` may return the numbers of the words that stand in for
    a text's words, in order, or None for the text as it is.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*(c for c in ("n_words", "runs", "collapsed") if c not in (text, key)))
    schema = StructType(docs.schema.fields + StructType.fromDDL(ADDED).fields)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    text_at, key_at = docs.columns.index(text), docs.columns.index(key)

    def run(batches):
        for batch in batches:
            counts, found, rest = [], [], []
            for name, value in zip(batch.column(key_at), batch.column(text_at), strict=True):
                words = bytes(value.as_buffer()).split() if value.is_valid else []
                chosen = arrange(name.as_py(), len(words)) if arrange and words else None
                if chosen is not None:
                    words = [words[i] for i in chosen]
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
                runs = find_runs(ids, least, times)
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
                rest.append(collapse(words, runs).decode())
            added = [pa.array(counts, pa.int64()), pa.array(found, run_type), pa.array(rest, pa.string())]
            yield pa.RecordBatch.from_arrays(batch.columns + added, names=batch.schema.names + ["n_words", "runs", "collapsed"])

    return docs.mapInArrow(giving_back(run), schema)
