"""Periodic runs, line dedup and centroid clustering against brute force, and odd rows."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import centroids, lines, queries, runs
from ledgerline.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words, least=24, times=3):
    """Every period in turn: stretches in which words that far apart are equal."""
    w = np.unique(np.array(list(words), dtype=object).astype(str), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    n, found = len(w), []
    for q in range(1, n // times + 1):
        same = np.concatenate(([0], (w[:-q] == w[q:]).astype(int), [0]))
        begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)
        for s, e in zip(begin, end, strict=True):
            length = int(e - s + q)
            if length >= max(least, times * q) and not any(a <= s and s + length <= a + b and q % p == 0 for a, b, p in found):
                found.append((int(s), length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(1, 9), st.integers(0, 70))
def test_runs_of_random_words(noise, period, length):
    unit = noise[:period] or [0]
    words = noise + [unit[i % len(unit)] for i in range(length)] + noise[::-1]
    ids = np.array(words, np.int64)
    assert runs.find_runs(ids) == brute_runs(words)
    assert runs.find_runs(ids, least=2, times=2) == brute_runs(words, 2, 2)


def test_runs_of_structured_words():
    fib, other = [0, 1], [0]
    while len(fib) < 700:
        fib, other = fib + other, fib
    thue = [bin(i).count("1") % 2 for i in range(512)]
    for words in ([7] * 500, fib, thue, thue * 4, ([1, 2] * 30 + [3]) * 5, [1] * 23, [1] * 24, [1, 2, 3, 4, 5, 6, 7, 8] * 3, [1, 2, 3, 4, 5, 6, 7, 8] * 3 + [9]):
        ids = np.array(words, np.int64)
        assert runs.find_runs(ids) == brute_runs(words)
        assert runs.find_runs(ids, 4, 2) == brute_runs(words, 4, 2)
    assert runs.shared_words(24, 3) == 16


def odd_docs(spark):
    schema = "doc_id bigint, text string, n_words string, runs int, collapsed string, n_lines string, n_dropped int, id string, digest string, segment int, gone_id string"
    cycle = "alpha beta gamma delta " * 9
    texts = [
        (1, None), (2, ""), (3, " \t\r\n "), (4, cycle), (4, cycle), (5, "a " * 23), (6, "a\x0bA b " * 40), (None, cycle), (None, None), (7, "x" * 300_000),
        (8, "one two three four five six\n" * 40), (9, "  ONE two three four FIVE six \r\nshort\nshort\n\n\nunique line of nine"), (10, "ß" * 9 + "\n" + "ß" * 10), (11, "ß" * 10 + "\t\nß"),
        (12, "q " * 200_000 + "end"), (13, "İstanbul line\nistanbul LINE"), (14, "i̇stanbul line\n \n"),
    ]
    return spark.createDataFrame([(i, t, "c", 1, "x", "n", 2, "i", "d", 3, "g") for i, t in texts], schema)


def brute_collapse(words, found):
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_periodic_runs_odd_rows(spark):
    docs = odd_docs(spark)
    got = runs.periodic_runs(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        words = WORD.findall(r.text or "")
        if len(words) < 5000:
            expected = brute_runs(words)
        else:
            expected = [(0, 200_000, 1)]
        assert [tuple(x) for x in r.runs] == expected
        assert r.n_words == len(words) and r.collapsed == brute_collapse(words, expected)
        assert (r.id, r.segment) == ("i", 3)
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_periodic_runs_query_equals_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    got = {r.doc_id: r for r in queries.op13_periodic_runs(spark, sf).collect()}
    assert got.keys() == docs.keys()
    some = 0
    for doc_id, text in docs.items():
        words = WORD.findall(text or "")
        chosen = queries.repeated_tail(doc_id, len(words)) if words else None
        if chosen is not None:
            words = [words[i] for i in chosen]
        if len(words) > 3000:
            continue  # brute force is quadratic
        r, found = got[doc_id], brute_runs(words)
        assert r.n_runs == len(found)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapse(words, found).encode()).hexdigest()
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None,) * 3)
        assert (r.start, r.length, r.period) == best
        assert r.exponent_milli == (best[1] * 1000 // best[2] if found else None)
        some += bool(found)
    assert some > 20


def brute_lines(rows, least=10):
    key = lambda line: re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                if len(key(line)) >= least:
                    holders[key(line)].add(i)
    out = []
    for i, t in rows:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if i is None or len(key(x)) < least or min(holders[key(x)]) == i]
        out.append((i, len(all_lines), len(all_lines) - len(kept), None if t is None else "\n".join(kept)))
    return out


def sortable(rows):
    return sorted(rows, key=repr)


def test_line_dedup_odd_rows(spark):
    docs = odd_docs(spark)
    got = lines.drop_repeated_lines(docs).collect()
    assert sortable((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == sortable(brute_lines([(r.doc_id, r.text) for r in docs.collect()]))
    assert all((r.id, r.gone_id) == ("i", "g") for r in got)
    assert lines.drop_repeated_lines(docs.limit(0)).collect() == []


def test_line_dedup_with_many_segments_and_hot_lines(spark, monkeypatch):
    """Small segments and gathers, so that hot segments are dealt to several tasks."""
    monkeypatch.setattr(lines, "SEGMENT", 64)
    monkeypatch.setattr(lines, "BITS", 512)
    monkeypatch.setattr(lines, "GATHER", 100)
    rng = random.Random(3)
    rows = []
    for i in range(900):
        own = [f"line number {rng.randrange(2500)} of all" for _ in range(rng.randrange(6))]
        rows.append((i, "\n".join(own + (["Everyone has this line"] if i % 3 else []) + ["tiny"])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    got = lines.drop_repeated_lines(docs).collect()
    assert sortable((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in got) == sortable(brute_lines(rows))
    found = docs.select("doc_id", "text").mapInArrow(lines._digests(10), "id bigint, digest binary")
    suspect = {(r.id, bytes(r.digest)) for r in lines.suspects(found).collect()}
    every = [(i, lines.digest(k)) for i, t in rows for k in {lines.line_key(x.encode(), 10) for x in t.split("\n")} - {None}]
    held = defaultdict(set)
    for i, d in every:
        held[d].add(i)
    assert {x for x in every if len(held[x[1]]) > 1} <= suspect  # none lost
    assert len(suspect) < len(every)


def brute_clusters(rows, k=40, rounds=5, dim=64):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    centres = [list(q) for _, q in named[:k]]
    place = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, q in kept:
            members[place(q)[1]].append(q)
        for n, m in members.items():
            centres[n] = [sum(x) // len(m) for x in zip(*m, strict=True)]
    found = [(i, *reversed(place(q))) for i, q in kept]
    inertia = defaultdict(int)
    for _, c, d in found:
        inertia[c] += d
    return [(i, c, d, inertia[c], sum(inertia.values()), centres[c]) for i, c, d in found]


def test_centroids_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((9, 8)) * [9, 5, 3, 1, 0.3, 0.1, 0.1, 0]
    rows = [(int(i), (base[i % 9] + rng.standard_normal(8) * 0.4).tolist()) for i in range(300)]
    rows += [(i, rows[i][1]) for i in range(40)] + [(500 + i, rows[0][1]) for i in range(60)]  # repeated rows and equal vectors
    rows += [(None, rows[3][1]), (901, None), (902, []), (903, [1.0] * 7), (904, [float("nan")] * 8), (905, [float("inf")] + [0.0] * 7), (906, [None] + [0.0] * 7), (907, [0.0] * 8)]
    vectors = spark.createDataFrame([(*r, "c", 1, 2.0) for r in rows], "vec_id bigint, embedding array<double>, cluster string, id int, rest double")
    for k in (1, 12, 40):
        got = centroids.cluster(vectors, dim=8, k=k).collect()
        assert sortable(map(tuple, got)) == sortable(brute_clusters(rows, k, dim=8))
    assert centroids.cluster(vectors.limit(0), dim=8).collect() == []
    few = spark.createDataFrame(rows[:1], "vec_id bigint, embedding array<double>")
    assert [tuple(r) for r in centroids.cluster(few, dim=8).collect()] == brute_clusters(rows[:1], dim=8)


def test_centroids_too_large_raise(spark):
    big = spark.createDataFrame([(1, [1e300, 0.0]), (2, [0.0, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="integer reaches"):
        centroids.cluster(big, dim=2).collect()


def test_filtering_measures_few_and_never_misses():
    rng = np.random.default_rng(8)
    centre = rng.integers(-200, 200, (40, 64))
    q = centre[rng.integers(0, 40, 3000)] + rng.integers(-20, 20, (3000, 64))
    basis = np.linalg.qr(np.linalg.svd(q - q.mean(axis=0), full_matrices=False)[2].T[:, : centroids.LEAD], mode="complete")[0]
    number, distance, measured = centroids.nearest(q, *centroids.rotate(q, basis), centre, basis)
    full = ((q[:, None] - centre[None]) ** 2).sum(axis=2)
    assert (number == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert measured < 2 * len(q)  # of 40 a vector
