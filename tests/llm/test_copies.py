"""Repeated passages and the Jaccard join against plain Python, in small and large settings."""
import hashlib
import itertools
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from abono.llm import jaccard, repeats
from abono.llm.graph import components
from abono.llm.text import piece_of

DDL = "doc_id long, text string, node long, spans string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    word = ["".join(rng.choice(list("abcdefgh"), int(n))) for n in rng.integers(1, 7, 300)]
    text = lambda n: " ".join(rng.choice(word, n))
    base = [text(60) for _ in range(6)]
    out = [None, "", "  ", "one", "one two", "One  TWO", "aaaa" * 30, LONG := text(3000), LONG]
    for t in base:
        out += [t, t.upper()]
        for _ in range(4):
            own = t.split(" ")
            for k in rng.integers(0, 60, int(rng.integers(1, 5))).tolist():
                own[k] = str(rng.choice(word))
            out.append(" ".join(own))
        out.append(text(20) + " é " + t[40:140] + " " + text(20))
    return [(i, t, 1, "x") for i, t in enumerate(out)] + [(4, "one two", 1, "x"), (None, base[0], 1, "x")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DDL)


def removed(texts, length, first):
    """Bytes to remove of each text; texts are in order."""
    seen = {}
    for i, t in enumerate(texts):
        for k in range(len(t) - length + 1):
            seen.setdefault(t[k:k + length], []).append((i, k))
    gone = [set() for _ in texts]
    for places in seen.values():
        for i, k in places[1:] if first else places if len(places) > 1 else []:
            gone[i] |= set(range(k, k + length))
    return gone


@pytest.mark.parametrize("first,group", [(True, 20_000), (False, 20_000), (False, 1), (True, 1)])
def test_repeats(docs, rows, first, group):
    params = repeats.Params(length=24, gram=8, group=group, batch=2_000)
    got = repeats.remove_repeats(docs, keep_first=first, params=params)
    key = lambda x: (x[0] is not None, x[0] or 0)
    # equal rows count as one where the first stays
    order = sorted(rows, key=key)
    texts = [(t or "").encode() for _, t, _, _ in order]
    gone = removed(texts, params.length, first)
    want = sorted((key(r), len(t), len(g), hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in g)).hexdigest()) for r, t, g in zip(order, texts, gone))
    found = sorted((key((r.doc_id,)), r.n_bytes, r.n_removed, r.kept_sha256) for r in repeats.repeats_digest(got).collect())
    assert found == want


def test_no_documents(docs):
    assert repeats.remove_repeats(docs.limit(0)).count() == 0
    assert jaccard.jaccard_classes(docs.limit(0)).count() == 0


def test_previous_smaller():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 200):
        x = rng.permutation(n)
        want = [next((j for j in range(i - 1, -1, -1) if x[j] < x[i]), -1) for i in range(n)]
        assert repeats.previous_smaller(x).tolist() == want


def test_suffix_order():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    start = np.arange(0, 300 - 21)
    order, classes = repeats.window_order(data, start, 21)
    windows = [data[k:k + 21].tobytes() for k in start]
    assert [windows[k] for k in order] == sorted(windows)
    assert all((windows[a] == windows[b]) == (classes[a] == classes[b]) for a, b in itertools.product(range(0, 279, 7), repeat=2))


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("least,n", [(Fraction(9, 10), 3), (Fraction(8, 10), 5), (Fraction(1, 2), 3)])
@pytest.mark.parametrize("block,hold,crowd", [(2_000_000, 4_000_000, 5_000), (200, 50, 2)])
def test_jaccard(docs, rows, least, n, block, hold, crowd):
    params = jaccard.Params(words=n, least=least, block=block, hold=hold, crowd=crowd)
    got = jaccard.jaccard_classes(docs, params=params)
    sets = [shingles(t, n) for _, t, _, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and len(sets[i] & sets[j]) * least.denominator >= len(sets[i] | sets[j]) * least.numerator:
            root[find(j)] = find(i)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    key = lambda a, b, c: (a is None, a or 0, b, c is None, c or 0)
    want = sorted(key(r[0], len(s), ids.get(find(i)) if s else r[0]) for i, (r, s) in enumerate(zip(rows, sets)))
    assert sorted(key(r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == want


@pytest.mark.parametrize("block", [4_000_000, 40])
def test_jaccard_reads_the_text_of_each_node(spark, block):
    """Null and repeated ids: nodes of one id get their own texts, one each."""
    near = lambda k: [" ".join([f"{k}w{i}" for i in range(60)] + [f"end{j}"]) for j in range(8)]
    rows = [(None, t) for k in "abc" for t in near(k)] + [(7, t) for k in "de" for t in near(k)] + [(i, t) for i, t in enumerate(near("f"))]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string").repartition(3)
    got = jaccard.jaccard_classes(docs, params=jaccard.Params(block=block)).collect()
    assert len(got) == 2 * len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, classes.values())) == [8] * 6
    texts = jaccard._texts(docs.coalesce(1), "doc_id", "text", jaccard.Params()).collect()
    assert len(texts) == len(rows)
    for r in texts:
        assert jaccard.node_of(jaccard.sets_of(piece_of([r.t]), jaccard.Params())[0]) == r.node


def test_jaccard_pivot_has_the_nodes_set(spark, monkeypatch):
    """Rows that reach the comparison are the nodes', one for each, with the nodes' sets."""
    seen = []
    small, large = jaccard._small, jaccard._large
    monkeypatch.setattr(jaccard, "_small", lambda texts, p: seen.append(texts) or small(texts, p))
    monkeypatch.setattr(jaccard, "_large", lambda texts, p: seen.append(texts) or large(texts, p))
    base = [" ".join(f"{k}w{i}" for i in range(50)) for k in "ab"]
    rows = [(None, f"{t} {j}") for t in base for j in range(6)] * 2
    p = jaccard.Params(block=40)
    jaccard.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), params=p).count()
    found = [r for texts in seen for r in texts.collect()]
    assert len(found) == len({r.node for r in found}) == 12
    assert all(jaccard.node_of(jaccard.sets_of(piece_of([r.t]), p)[0]) == r.node for r in found)


def test_fragments_meet():
    """Any two linked sets have a key in common."""
    rng = np.random.default_rng(6)
    for least, lost, more in ((Fraction(9, 10), 0.1, 0.05), (Fraction(8, 10), 0.1, 0.05), (Fraction(8, 10), 0.2, 0.02), (Fraction(1, 2), 0.4, 0.1)):
        p = jaccard.Params(least=least)
        for _ in range(1_000):
            a = set(rng.integers(0, 1 << 62, int(rng.integers(1, 60))).tolist())
            b = set(a)
            for x in list(a):
                if rng.random() < lost:
                    b.discard(x)
                if rng.random() < more:
                    b.add(int(rng.integers(0, 1 << 62)))
            if b and len(a & b) * least.denominator >= len(a | b) * least.numerator:
                grams = [np.array(sorted(x), dtype=np.uint64) * np.uint64(4) for x in (a, b)]
                text, key = jaccard.fragment_keys(np.concatenate(grams), np.array([0, len(a), len(a) + len(b)]), p)
                assert set(key[text == 0].tolist()) & set(key[text == 1].tolist())


@pytest.mark.parametrize("size", [4, 9, 19, 62, 94])
def test_unlike_sets_have_no_key_in_common(size):
    """Also those that fill few fragments: no key stands for a whole size class."""
    rng = np.random.default_rng(size)
    grams = np.sort(rng.integers(0, 1 << 62, (5_000, size)).astype(np.uint64) * np.uint64(4), axis=1).ravel()
    p = jaccard.Params(words=5, least=Fraction(8, 10))
    text, key = jaccard.fragment_keys(grams, np.arange(5_001) * size, p)
    assert len(np.unique(key)) == len(key) and len(np.unique(text)) == 5_000


def test_very_many_unlike_documents(spark):
    """100,000 documents of 19 five-word runs, and two near copies: nothing else is connected."""
    word = lambda i: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", F.lit(i)), F.lit(50_000)))
    docs = spark.range(100_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[word(i) for i in range(23)]).alias("text"))
    near = docs.where("doc_id = 70000").select((F.col("doc_id") + 100_000).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text"))
    docs = docs.unionByName(near)
    p = jaccard.Params(words=5, least=Fraction(8, 10))
    marks = jaccard.nodes_of(docs, ["doc_id", "text"], params=p)
    assert jaccard._keyed(docs, "text", p).groupBy("key").agg(F.countDistinct("node").alias("n")).agg(F.max("n")).first()[0] == 2
    got = jaccard.jaccard_classes(docs, params=p).where("component_id != doc_id").collect()
    assert [(r.doc_id, r.component_id, r.n_shingles) for r in got] == [(170_000, 70_000, 20)]
    assert marks.where("n_shingles != 19").count() == 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (102, 103), (200, 200)] + [(300 + i, 300) for i in range(1, 20)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 104)}, **{i: 300 for i in range(300, 320)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_repeats_of_null_ids_whose_texts_share_a_short_hash(spark):
    """Two texts without ids and with equal 32-bit hashes: only the one that repeats loses bytes."""
    texts = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("t"))
    same = texts.groupBy(F.hash("t").alias("h")).agg(F.sort_array(F.collect_list("t")).alias("t")).where("size(t) > 1")
    twice, alone = same.orderBy("h").first()["t"][:2]
    docs = spark.createDataFrame([(None, twice), (None, alone), (1, twice)], "doc_id long, text string")
    params = repeats.Params(length=24, gram=8)
    for first, lost in ((False, {(None, twice): 64, (None, alone): 0, (1, twice): 64}),
                        (True, {(None, twice): 0, (None, alone): 0, (1, twice): 64})):
        got = repeats.remove_repeats(docs, keep_first=first, params=params).collect()
        kept = sorted((r.doc_id is None, bytes(r.kept).decode()) for r in got)
        assert kept == sorted((i is None, "" if n else t) for (i, t), n in lost.items())
