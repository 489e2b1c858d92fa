"""Registered text queries against their SQL, and the pipeline against brute force."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from abono.llm.queries import ORACLES, QUERIES
from given_tables.compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"op13_spelling"}))
def test_a_row_for_each_row(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumns({c: F.lit(1) for c in ("score", "hit_words", "redacted", "__c1", "node")})
    first = {r.doc_id: r.text for r in docs.collect()}
    before = set(first)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        if k + 1 < len(corpus_pipeline.STAGES):
            assert after.columns == docs.columns
        kept = {r.doc_id for r in after.collect()}
        if name == "near copies":
            sets = {i: _shingles(first[i]) for i in before}
            for i in before - kept:
                assert any(j < i and _alike(sets[i], sets[j]) for j in before)
            assert not any(i < j and sets[i] and _alike(sets[i], sets[j]) for i in kept for j in kept)
        elif name in ("secrets", "pieces"):
            assert kept == before
        else:
            assert kept <= before and len(kept) > len(before) / 2
        before, docs = kept, after
    assert corpus_pipeline.run(spark, SF).count() == len(before)


def test_near_copies_with_null_and_repeated_ids(spark):
    base = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcdef"}
    rows = [
        (1, base["a"]), (None, base["a"] + " end"), (None, base["b"]), (None, None), (None, " "), (None, ""), (None, ""),  # null ids
        (2, base["c"]), (3, base["c"] + " end"), (3, base["d"]), (4, base["d"] + " end"),  # 3 twice, one a later copy
        (None, base["e"]), (None, base["e"] + " end"), (None, base["e"]),  # a class of null ids alone
        (5, base["f"]), (5, base["f"].upper()), (5, base["f"]), (6, None), (6, ""),
    ]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, node int")
    got = corpus_pipeline.one_of_near_copies(spark, docs, SF)
    assert got.columns == docs.columns
    found = sorted(((r.doc_id or 0, r.text or "", r.text is None) for r in got.collect()))
    fixed = [(1, base["a"]), (None, base["b"]), (None, None), (None, " "), (None, ""), (2, base["c"]), (3, base["d"]), (6, None), (6, "")]
    own = [x for x in found if x[1][:2] in ("e0", "f0", "F0")]
    assert sorted(x for x in found if x not in own) == sorted((i or 0, t or "", t is None) for i, t in fixed)
    assert [i for i, _, _ in own] == [0, 5]


def _shingles(text):
    w = [x for x in (text or "").translate({i: i + 32 for i in range(65, 91)}).replace("\n", " ").split(" ") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def _alike(a, b):
    return 10 * len(a & b) >= 8 * len(a | b)
