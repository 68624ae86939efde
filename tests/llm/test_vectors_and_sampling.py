"""NN-descent against brute force, and sampled segmentations against enumeration."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from ledgerline.llm import sampling, vectors
from ledgerline.llm.common import text_chunks

INF = float("inf")


def brute_vectors(rows, threshold=0.98):
    n = len(rows)
    ok = [v is not None and lab is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links, up = [0] * n, list(range(n))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    unit = [np.array(v, float) / np.abs(v).max() if k else None for (_, v, _), k in zip(rows, ok, strict=True)]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i in range(n):
        if rows[i][0] is not None:
            least[top(i)].append(rows[i][0])
    return Counter((rows[i][0], links[i], min(least[top(i)]) if rows[i][0] is not None else None) for i in range(n))


def test_vectors_odd_rows_and_dense_group(spark, monkeypatch):
    monkeypatch.setattr(vectors, "GROUP", 32)
    rng = np.random.default_rng(5)
    base = rng.standard_normal(16)
    rows = [(i, (base + 0.05 * rng.standard_normal(16)).tolist(), 1) for i in range(150)]  # one dense group, lists saturate
    rows += [(200 + i, rng.standard_normal(16).tolist(), i % 3) for i in range(300)]
    rows += [(600 + i, (np.array(rows[150 + i][1]) + 0.06 * rng.standard_normal(16)).tolist(), rows[150 + i][2]) for i in range(60)]
    rows += [(700 + i, base.tolist(), 2) for i in range(40)] + [(750 + i, (base * 3).tolist(), 2) for i in range(5)]
    rows += [(800, None, 1), (801, [], 1), (802, [0.0] * 16, 1), (803, [1.0, None] * 8, 1), (804, [float("nan")] * 16, 1), (805, [INF] * 16, 1), (806, base.tolist(), None), (807, [1.0, 2.0], 1), (808, [1.0, 2.0], 1), (None, base.tolist(), 2)]
    rows += [(200, rows[150][1], rows[150][2])]  # a repeated row
    rows += [(810, [1e300] * 16, 0), (811, [1e-200] * 16, 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, id string, grp int")
    got = vectors.near_duplicates(df).collect()
    expected = brute_vectors(rows)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == expected
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)
    assert vectors.near_duplicates(df.limit(0)).collect() == []


def tight_groups(rng, centres, size):
    """Groups of cosine 0.995 inside, around the given centres."""
    out = []
    for c in centres:
        for _ in range(size):
            z = rng.standard_normal(len(c))
            z -= (z @ c) * c
            out.append(c * np.sqrt(0.9975) + z / np.linalg.norm(z) * np.sqrt(0.0025))
    return out


def test_links_between_saturated_groups(spark):
    """Two tight groups of 20, 0.985 across, among 500 others: their lists hold their own group only."""
    rng = np.random.default_rng(11)
    c = np.linalg.qr(rng.standard_normal((48, 2)))[0].T
    across = 0.989
    vectors_ = tight_groups(rng, [c[0], across * c[0] + np.sqrt(1 - across**2) * c[1]], 20)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors_)] + [(100 + i, rng.standard_normal(48).tolist(), 1) for i in range(500)]
    expected = brute_vectors(rows)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert max(n for _, n, _ in expected) > 25
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()) == expected


def test_missed_recall_is_made_up_exactly(spark, monkeypatch):
    monkeypatch.setattr(vectors, "_links", lambda graph, classes, threshold: graph.sparkSession.createDataFrame([], "a bigint, b bigint"))
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(12)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(tight_groups(rng, [np.eye(16)[0], np.eye(16)[1]], 20))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(df).collect()) == brute_vectors(rows)


def test_audit_counts_losses(spark):
    x = np.eye(8)[[0, 0, 1, 1]] + 0.01 * np.arange(8)
    classes = spark.createDataFrame([(i, 5, v.tolist(), 1 + i) for i, v in enumerate(x)], "id bigint, grp bigint, x array<double>, size bigint")
    links = spark.createDataFrame([(0, 1)], "a bigint, b bigint")
    degrees = vectors._degrees(links, classes)
    assert {tuple(r) for r in degrees.collect()} == {(0, 2), (1, 1)}
    assert vectors.audit(classes, degrees, 0.98) == (2 + 1 + 4 + 3, 3)


def test_blocks_give_counts_and_a_forest(spark):
    """A dense group of several blocks: rows in proportion to its members, not its links."""
    rng = np.random.default_rng(2)
    x = np.eye(16)[0] + 0.005 * rng.standard_normal((900, 16))
    inside = spark.createDataFrame([(i, 3, 2, v.tolist()) for i, v in enumerate(x)], "id bigint, part bigint, size bigint, x array<double>")
    size = spark.createDataFrame([(3, 900)], "part bigint, n bigint")
    pairs = spark.createDataFrame([(3, 3)], "a bigint, b bigint")
    found = vectors._blocks(pairs, inside, size, 0.98).collect()
    degree = Counter()
    for r in found:
        if not r.is_edge:
            degree[r.a] += r.b
    assert degree == {i: 2 * 899 for i in range(900)}
    assert len(found) < 900 * 4 * 4  # of 404,550 links
    parent = vectors._groups(np.array([r.a for r in found if r.is_edge]), np.array([r.b for r in found if r.is_edge]), 900)
    assert (parent == 0).all()


PIECES = ["<unk>", "<s>", "</s>", *(f"<0x{i:02X}>" for i in range(256)), "▁a", "b", "▁", "a", "ab", "▁ab", "c", "bc", "abc", "▁▁"]


def segmentations(vocabulary, text):
    raw = (" " + text).encode() if text else b""
    known = {vocabulary.bytes[i]: i for i in range(sampling.FIRST_PIECE, len(vocabulary.bytes))}
    out = []

    def go(at, ids, log_p):
        if at == len(raw):
            out.append((tuple(ids), log_p))
            return
        for piece, i in known.items():
            if raw.startswith(piece, at):
                go(at + len(piece), [*ids, i], log_p + vocabulary.weight[i])
        char = raw[at:].decode()[0].encode()
        if char not in known:
            go(at + len(char), ids + [b + 3 for b in char], log_p + sum(vocabulary.weight[b + 3] for b in char))

    go(0, [], 0.0)
    total = np.logaddexp.reduce([p for _, p in out])
    return {ids: p - total for ids, p in out}


def sampled(vocabulary, texts, keys, k):
    rows = defaultdict(list)
    for first, end, data, offsets in text_chunks(pa.array(texts), 1 << 30):
        found, kappa = sampling.top_k(vocabulary, data, offsets, keys[first:end], k)
        for r, ids, at, log_p, perturbed in found:
            for x, row in enumerate(r):
                rows[row].append((tuple(ids[at[row] : at[row + 1]].tolist()), log_p[x], perturbed[x]))
    return rows, kappa


def test_samples_follow_the_distribution_without_replacement():
    vocabulary = sampling.Vocabulary(PIECES)
    n, k, text = 6000, 3, "abc ab"
    rows, kappa = sampled(vocabulary, [text] * n, np.arange(n, dtype=np.uint64) * np.uint64(7919), k)
    p = {i: np.exp(x) for i, x in segmentations(vocabulary, text).items()}
    first, second = Counter(rows[r][0][0] for r in range(n)), Counter(rows[r][1][0] for r in range(n))
    for i in p:
        assert first[i] / n == pytest.approx(p[i], abs=0.03)
        assert second[i] / n == pytest.approx(sum(p[j] * p[i] / (1 - p[j]) for j in p if j != i), abs=0.03)
    scores = 0.0
    for r in range(n):
        assert len({i for i, _, _ in rows[r]}) == k
        assert [g for _, _, g in rows[r]] == sorted((g for _, _, g in rows[r]), reverse=True) and rows[r][-1][2] >= kappa[r]
        for i, log_p, _ in rows[r]:
            assert log_p == pytest.approx(np.log(p[i]))
            scores += p[i] / -np.expm1(-np.exp(log_p - kappa[r]))
    assert scores / n == pytest.approx(1.0, abs=0.05)  # inclusion scores make sums unbiased


def test_short_texts_list_every_segmentation():
    vocabulary = sampling.Vocabulary(PIECES)
    texts = ["", "é", "x\nab", "ab", "  ", "a\n\n b", "▁a", "\n", "abcabc"]
    rows, kappa = sampled(vocabulary, texts, np.arange(len(texts), dtype=np.uint64), 40)
    for r, text in enumerate(texts):
        every = segmentations(vocabulary, text)
        assert {i for i, _, _ in rows[r]} <= set(every) and len(rows[r]) == min(40, len(every))
        assert np.isinf(kappa[r]) == (len(every) <= 40)
        assert all(vocabulary.decode(np.array(i, np.int64)).decode() == text for i, _, _ in rows[r])


def test_sample_frame_round_trip_and_seed(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 150").select("doc_id", "text")
    odd = spark.createDataFrame([(1000, None), (1001, ""), (None, "ab c"), (1002, "x" * 60_000), (1003, "日本語 ▁ 😀 \x00\r\n" * 50), (1004, "same text"), (1004, "same text")], "doc_id bigint, text string")
    both = docs.union(odd)
    a = sampling.sample(both)
    rows = a.collect()
    assert all(r.round_trip for r in rows) and all(0 <= r.inclusion <= 1 and np.isfinite(r.log_inclusion) and r.log_inclusion <= 0 for r in rows)
    count = Counter(r.doc_id for r in rows)
    assert count[1000] == count[1001] == 1 and count[1002] == 2 and count[1004] == 4
    decoded = {(r.doc_id, r["sample"]): r.text for r in sampling.decode(a.withColumnRenamed("round_trip", "text")).collect()}
    texts = {r.doc_id: r.text or "" for r in both.collect()}
    assert all(texts[i] == t for (i, _), t in decoded.items())
    again = {(r.doc_id, r["sample"]): r.ids for r in sampling.sample(both.repartition(7)).collect()}
    assert all(again[r.doc_id, r["sample"]] == r.ids for r in rows)
    other = {(r.doc_id, r["sample"]): r.ids for r in sampling.sample(docs, seed=1).collect()}
    assert sum(other[k] != again[k] for k in other) > len(other) / 2
    assert sampling.sample(both.limit(0)).collect() == []


def test_split_places_that_cannot_win_are_left_out(monkeypatch):
    """Equal samples whatever the reach and the blocks, and no noise for every place of a long text."""
    vocabulary = sampling.Vocabulary(PIECES)
    draw = random.Random(5)
    texts = ["", "\n", *(" ".join("".join(draw.choice("abcé") for _ in range(draw.randint(1, 9))) for _ in range(n)) for n in (1, 3, 40, 2000))] * 3
    keys = np.arange(len(texts), dtype=np.uint64) * np.uint64(7919)
    drawn, gumbel = [], sampling._gumbel
    monkeypatch.setattr(sampling, "_gumbel", lambda u: drawn.append(len(u)) or gumbel(u))
    plain = sampled(vocabulary, texts, keys, 3)
    places = sum(len(ids) for found in plain[0].values() for ids, _, _ in found)
    assert places > 100_000 and sum(drawn) < places / 4
    for reach, built, walked, kept in ((0.0, 1, 1, 0), (1e9, 1 << 20, 1 << 20, 50), (5.0, 7, 3, 1 << 20)):
        for name, value in (("REACH", reach), ("BUILT", built), ("WALKED", walked), ("KEPT_EDGES", kept)):
            monkeypatch.setattr(sampling, name, value)
        for vocabulary in (vocabulary, sampling.Vocabulary(PIECES)):  # with words kept from before, and without
            rows, kappa = sampled(vocabulary, texts, keys, 3)
            assert rows == plain[0] and (kappa == plain[1]).all()


def test_one_segmentation_only():
    """No second sample in the whole chunk."""
    rows, kappa = sampled(sampling.Vocabulary(PIECES), ["\n", "", "\n\n"], np.arange(3, dtype=np.uint64), 2)
    assert [len(rows[r]) for r in range(3)] == [1, 1, 1] and np.isinf(kappa).all()


def test_round_trip_finds_every_wrong_row():
    vocabulary = sampling.Vocabulary(PIECES)
    at_id = {b: i for i, b in enumerate(vocabulary.bytes) if b}
    rows = [[b" a", b"b"], [], [b" a", b"c"], [b" ", b"b"], [b" a"], [b" ", b"c"]]
    texts = ["ab", "", "ab", "b", "a c", "c"]
    _, _, data, offsets = next(text_chunks(pa.array(texts), 1 << 20))
    at = np.cumsum([0, *map(len, rows)])
    ids = np.array([at_id[b] for row in rows for b in row], np.int32)
    assert vocabulary.equal(ids, at, data, offsets).tolist() == [True, True, False, True, False, True]
