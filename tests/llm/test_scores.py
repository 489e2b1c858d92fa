"""Toxicity and quality: exact parts against plain Python, accuracy on held-out documents."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from abono.llm import quality, toxicity
from abono.llm.labelled import labelled, remainder

DDL = "doc_id long, text string, score string, slots string"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(8)
    word = ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(400)]
    rows = []
    for i in range(600):
        own = list(rng.choice(word, 40))
        if i % 3 == 0:
            own[int(rng.integers(0, 40))] = "vileword"
            own[int(rng.integers(0, 40))] = "vilewords"
        if i % 5 == 0:
            own = [w + "$$$" for w in own]
        rows.append((i, " ".join(own), "x", "y"))
    return spark.createDataFrame([*rows, (600, None, "x", "y"), (601, "", "x", "y"), (0, rows[0][1], "x", "y")], DDL)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 5 > 0), int(i % 3 == 0)) for i in range(600)] + [(None, 1, 1), (601, None, None), (9999, 1, 0), (3, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("op,label,params", [(toxicity.toxicity, "toxic", toxicity.Params(slots_log2=14, prior=2000.0, significant=2.0)), (quality.quality, "quality", quality.Params(slots_log2=14))])
def test_held_out(docs, labels, op, label, params):
    scored = op(docs, labels, allowed=remainder("doc_id", 3) != 1, params=params)
    rows = {r.doc_id: r.score for r in scored.where(remainder("doc_id", 3) == 1).collect()}
    truth = {r.doc_id: r[label] for r in labels.where("doc_id < 600").collect()}
    right = [int(rows[i] >= 0.5) == truth[i] for i in rows if i < 600]
    assert len(right) > 100 and np.mean(right) > 0.97
    every = scored.collect()
    assert len(every) == 603 and all(0 <= r.score <= 1 for r in every)
    by = {}
    for r in every:
        assert by.setdefault(r.doc_id, r.score) == r.score
    assert by[600] == by[601]


@pytest.mark.parametrize("op", [toxicity.toxicity, quality.quality])
def test_nothing_to_learn_from(docs, labels, op):
    for some in (labels.limit(0), labels.where("toxic = 0 and quality = 1")):
        assert len({r.score for r in op(docs, some, allowed=F.lit(True)).collect()}) == 1
    assert op(docs.limit(0), labels, allowed=F.lit(True)).count() == 0


def test_sample_is_bounded_and_stable(labels):
    rows = labelled(labels, "doc_id", "toxic", F.lit(True), 50)
    assert 20 < rows.count() <= 100 and rows.collect() == labelled(labels, "doc_id", "toxic", F.lit(True), 50).collect()


def test_toxicity_by_the_counts_at_hand(docs, labels):
    """With no prior named, at two sizes of the same kind of table: better than a constant."""
    for n in (150, 600):
        some = docs.where(f"doc_id < {n}")
        scored = toxicity.toxicity(some, labels, allowed=remainder("doc_id", 3) != 1)
        held = scored.where(remainder("doc_id", 3) == 1).select("doc_id", "score").distinct().collect()
        right = [(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in held]
        assert len(right) > 30 and np.mean(right) > 0.9


def test_toxicity_of_any_layout(spark, docs, labels):
    """Copies whose witnesses differ by a word: which one is learned from must not depend on layout."""
    near = [(1000 + i, f"word{i % 7} " * 3 + "vileword and the same long tail of words that every copy has " + f"own{i}", "x", "y") for i in range(60)]
    rows = docs.unionByName(spark.createDataFrame(near, DDL))
    marks = labels.unionByName(spark.createDataFrame([(1000 + i, 1, i % 2) for i in range(60)], labels.schema))
    found = []
    for layout in (rows.coalesce(1), rows.repartition(7, "text"), rows.orderBy(F.desc("doc_id")).repartition(3)):
        scored = toxicity.toxicity(layout, marks, allowed=remainder("doc_id", 3) != 1)
        found.append(sorted(((r.doc_id, r.score, r.n_segments) for r in scored.collect())))
    assert found[0] == found[1] == found[2] and len({x[1] for x in found[0]}) > 2


def best_segments(scores):
    """The best segment, then those of what is left and right of it."""
    if not len(scores):
        return []
    total, where = 0.0, None
    for i in range(len(scores)):
        run = np.cumsum(scores[i:])
        j = int(run.argmax())
        if run[j] > total + 1e-12:
            total, where = run[j], (i, i + j + 1)
    if where is None:
        return []
    a, b = where
    return best_segments(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in best_segments(scores[b:])]


def test_segments():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n = rng.integers(0, 40, 3)
        scores, cuts = rng.normal(-0.1, 1, int(n.sum())), np.concatenate([[0], np.cumsum(n)])
        for i, found in enumerate(toxicity.segments(scores, cuts)):
            assert [(a, b) for a, b, _ in found] == best_segments(scores[cuts[i]:cuts[i + 1]])


def test_extreme_value():
    rng = np.random.default_rng(0)
    n = rng.integers(20, 2000, 20_000)
    rate, size = toxicity.extreme_value((np.log(0.1 * n) - np.log(-np.log(rng.random(len(n))))) / 1.7, n)
    assert abs(rate - 1.7) < 0.05 and abs(size - 0.1) < 0.02
