"""Aligned tokens against whole texts encoded by the libraries and a plain walk over both."""
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from abono.llm import crosstoken
from abono.llm.queries import BYTE_MODEL, MODEL, QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a ", "a  ", " a", "\n", "a\n b", "a  b", "a  b", "x▁y z", "don't 's  we'll", "<|endoftext|> <s> </s>", "a\0b c",
    "é à  ù ", "日本語 テスト  ok", "a\x1c b", "tab\t x", "😀 😀😀 x", "a" * 3000, "word, " * 40_000, "\u0085 a\u0085 b", "à b Ê c ¨ d ° e", "  x", "a　 b",
    "the same", "the same"]


@pytest.fixture(scope="module")
def models():
    return crosstoken.Models.read(BYTE_MODEL, MODEL)


@pytest.fixture(scope="module")
def walked(models):
    pair = crosstoken.Pair(models)
    names_a, names_b = pair.names_a.to_pylist(), pair.names_b.to_pylist()

    def walk(text):
        if not text:
            return 0, 0, "", []
        a, b = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text)
        whole = (" " + text).encode()
        if b"".join(names_a[i] for i in a) != whole or b"".join(names_b[i] for i in b) != whole:
            return 0, 0, "", []
        i = j = x = y = 0
        links, groups, ga, gb = [], [], [], []
        while i < len(a):
            links.append((a[i], b[j]))
            end_a, end_b = x + len(names_a[a[i]]), y + len(names_b[b[j]])
            if end_a <= end_b:
                ga.append(a[i])
                i, x = i + 1, end_a
            if end_b <= end_a:
                gb.append(b[j])
                j, y = j + 1, end_b
            if end_a == end_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        return len(a), len(b), ";".join(groups), links
    return walk


def brute(texts, walk):
    found = [walk(t) for t in texts]
    counts = Counter(x for *_, links in found for x in links)
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    return [(n_a, n_b, groups.count("|"), len(links), groups, sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links))
            for n_a, n_b, groups, links in found]


@pytest.mark.parametrize("params", [crosstoken.Params(), crosstoken.Params(most_pairs=0), crosstoken.Params(most_units=5), crosstoken.Params(most_pairs=0, most_units=5)])
def test_odd_texts(spark, models, walked, params):
    docs = spark.createDataFrame([(i if i % 5 else None, t, i, "x") for i, t in enumerate(ODD)], "doc_id long, text string, place int, a string")
    got = crosstoken.aligned(docs.repartition(3), models, keep=("place", "doc_id"), params=params).collect()
    got = [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")) for r in sorted(got, key=lambda r: r.place)]
    assert got == brute(ODD, walked)


def test_whole_query(spark, walked):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: x for r, x in zip(rows, brute([r.text for r in rows], walked))}
    got = QUERIES["op12_crosstoken"](spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        n_a, n_b, n_groups, n_links, groups, n_best, count_sum = want[r.doc_id]
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) == (n_a, n_b, n_groups, n_links, n_best, count_sum, digest)


def test_no_texts(spark, models):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert crosstoken.aligned(none, models).collect() == []
    null = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert [tuple(r) for r in crosstoken.aligned(null, models).collect()] == [(1, 0, 0, 0, 0, "", 0, 0)]


def test_units_by_shares(models, monkeypatch):
    units = [f" w{i}x{i * 7919 % 1009}".encode() for i in range(60_000)] + [b" " + b"ab" * crosstoken.SHARE, b" \xe2\x96\x81z", b" last"]
    pair, taken = crosstoken.Pair(models), []
    encode = pair.encode
    monkeypatch.setattr(pair, "encode", lambda part: taken.append(part) or encode(part))
    cut = crosstoken.Units(pair)
    cut.add(units[:30_000])
    cut.add(units[30_000:])
    assert [u for part in taken for u in part] == units == list(cut.index)
    assert max(sum(map(len, part)) for part in taken if len(part) > 1) <= crosstoken.SHARE
    weight = pa.array(np.arange(len(units)) % 3)
    got = crosstoken.counted(cut.links, weight)
    monkeypatch.setattr(crosstoken, "SHARE", 1 << 40)
    monkeypatch.setattr(crosstoken, "MANY", 1 << 40)
    whole = crosstoken.Units(pair)
    whole.add(units)
    assert cut.links == whole.links and cut.sizes == whole.sizes and cut.texts == whole.texts and cut.bytes == whole.bytes
    order = [("a", "ascending"), ("b", "ascending")]
    assert got.sort_by(order) == crosstoken.counted(whole.links, weight).sort_by(order)
    assert whole.links.nbytes == 12 * whole.links.num_rows


def test_units_of_other_texts(spark, models, walked):
    # one worker for both tables: it still knows the first one's units when it reads the second
    for texts in (["zebra quartz 7 xylophone", "many other words \U0001f600"], ["the same", "a the"]):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
        got = sorted(crosstoken.aligned(docs, models).collect())
        assert [tuple(r)[1:] for r in got] == brute(texts, walked)
