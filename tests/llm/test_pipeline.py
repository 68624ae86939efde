"""The corpus pipeline: every stage against its brute-force meaning, odd tables, plans."""

import re

import corpus_pipeline as pipeline
from test_documents import SCHEMA, brute_components, brute_quality, check_sequences, empty_docs, odd_docs


def test_stages_take_effect(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 200")
    columns = docs.columns
    frames = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, frames[-1], sf).write.parquet(f"{tmp_path}/{i}")
        frames.append(spark.read.parquet(f"{tmp_path}/{i}"))
    texts = [{r.doc_id: r.text for r in f.collect()} for f in frames[:5]]
    assert all(f.columns == columns for f in frames[:5])
    good = {i for i, t in texts[0].items() if (m := brute_quality(t))[0] >= 50 and 100 * m[5] <= 50 * m[0] and 10 * m[2] <= m[0] and 2 * m[4] <= m[3]}
    assert set(texts[1]) == good
    components = brute_components(list(texts[1].items()))
    assert set(texts[2]) == {i for (i, _), c in components.items() if i == c}
    assert set(texts[3]) == set(texts[2])
    seen = set()
    for i in sorted(texts[2]):
        b = texts[2][i].encode()
        own = {b[p : p + 50] for p in range(len(b) - 49)}
        assert (texts[3][i] == texts[2][i]) == (not own & seen)
        seen |= own
    assert set(texts[4]) == set(texts[3])
    assert not any(re.search(r'token = "[0-9a-f]{40}"', t) for t in texts[4].values())
    assert all(r.n_chars == len(r.text) for r in frames[4].collect())
    packed = frames[5].collect()
    assert {r.doc_id for r in packed} == set(texts[4])
    check_sequences(packed)


def test_near_stage_from_80_percent(spark):
    """Pairs planted from just under 0.80 to 0.85, against brute force at 80."""
    import random

    from ledgerline.llm import minhash

    rng = random.Random(8)
    rows = []
    for i in range(60):
        words = [f"d{rng.randrange(10**9)}" for _ in range(124)]
        k = 11 + i % 5  # of 120 shingles each, 120 - k shared: 0.832 to 0.778
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[k:] + [f"e{rng.randrange(10**9)}" for _ in range(k)]))]
    expected = {i for (i, _), c in brute_components(rows, 80).items() if i == c}
    assert expected != {i for (i, _), c in brute_components(rows).items() if i == c}
    got = pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), "").collect()
    assert {r.doc_id for r in got} == expected
    assert minhash.agreement(80) == 82 and minhash.agreement(85) < 92 and minhash.agreement(100) == minhash.SKETCH


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for i, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, "")
            if i < 4:
                assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
            rows = out.collect()
            assert docs is not None and (rows or not docs.count())
    ids = [r.doc_id for r in pipeline.near_duplicates(spark, odd_docs(spark), "").collect()]
    assert ids.count(1) == 1 and ids.count(2) == 0 and ids.count(None) == 2
    assert ids.count(5) == 2  # two texts under one id are two documents


def test_near_stage_with_several_texts_under_one_id(spark):
    """Every text under an id is judged alone; of equal rows one stays."""
    base = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(1, base, "b"), (1, base, "a"), (1, other, "c"), (2, base + " more", "d"), (3, other + " more", "e"), (4, "alone " + " ".join(f"u{i}" for i in range(60)), "f"), (4, "", "g"), (4, None, "h")]
    for docs in (rows, rows[::-1]):
        got = pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id bigint, text string, source string"), "").collect()
        assert sorted((r.doc_id, r.source) for r in got) == [(1, "a"), (1, "c"), (4, "f"), (4, "g"), (4, "h")]


def test_run_registered(spark, tmp_path):
    from ledgerline.llm.queries import ORACLE, QUERIES

    assert [name for name, _ in pipeline.STAGES] == ["quality rules", "MinHash near-dedup", "suffix-array dedup", "secret scans", "best-fit packing"]
    assert pipeline.ORACLE_SQL is None and "pipeline" not in ORACLE
    names = list(QUERIES)
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    spark.createDataFrame([(1, "word " * 10 + " ".join(f"w{i}" for i in range(60)), "en", "s", 1, "k", "i", 1, 2, "s", "p", 3)], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["pipeline"](spark, str(tmp_path)).count() == 1


def test_subpackage_is_not_imported_by_the_rest():
    import pathlib

    root = pathlib.Path(pipeline.__file__).parent
    for f in (root / "ledgerline").rglob("*.py"):
        if "llm" not in f.parts:
            assert "llm" not in re.findall(r"^(?:from|import) .*$", f.read_text(), re.M).__str__(), f
