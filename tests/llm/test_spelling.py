"""Spelling variants against plain Python: the index, the search schemes, and the whole query."""
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from abono.llm import spelling
from abono.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.fixture(scope="module")
def words():
    rng = random.Random(1)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(7, 10))) for _ in range(200)]
    more = {w[:i] + rng.choice("abéz") + w[i + 1:] for w in base for i in [rng.randrange(len(w))]}
    return sorted(set(base) | more | {"a" * k for k in range(7, 14)} | {"ab" * 4, "ba" * 4, "÷" * 7, "×" * 7})


def test_suffix_order():
    for text in ([1], [0, 0, 0], [2, 1, 2, 1, 0], list(np.random.default_rng(3).integers(0, 3, 200))):
        t = [int(x) for x in text]
        assert spelling.suffix_order(np.array(t)).tolist() == sorted(range(len(t)), key=lambda i: t[i:])


def test_both_directions_agree(words):
    """Extending to the left, to the right or from the middle finds as many places."""
    index = spelling.Index(words)
    joined = "#" + "#".join(words) + "#"
    for part in ("aba", "éa", "b", "aaaa", "ab#", "zz"):
        symbols = np.array([0 if c == "#" else int(index.symbols(np.array([ord(c)]))[0]) for c in part])
        want = len(re.findall(f"(?={part})", joined))
        for order in ([(k, True) for k in range(len(part) - 1, -1, -1)], [(k, False) for k in range(len(part))],
                      [(1, False), *[(k, False) for k in range(2, len(part))], (0, True)] if len(part) > 1 else []):
            state = index.start(1)
            for k, left in order:
                state = index.extend(state, symbols[k:k + 1][state.query], left)
            assert not order or int(state.size.sum()) == want


def test_near_pairs(words):
    queries = [*words, "abéabéq", "qqqqqqq"]
    found = []
    for first in (True, False):
        found += [(queries[q], words[w]) for q, w in zip(*spelling.near_pairs(words, queries, first))]
    assert len(found) == len(set(found))
    assert set(found) == {(q, w) for q in queries for w in words if one_edit(q, w)}


def brute(rows, noise=31):
    count = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    by_rest = {}
    for w in count:
        for i in range(len(w) + 1):
            by_rest.setdefault((w[:i], w[i:]), set()).add(w)
            if i < len(w):
                by_rest.setdefault((w[:i], w[i + 1:]), set()).add(w)
    near = {w: {x for i in range(len(w) + 1) for key in ((w[:i], w[i:]), (w[:i], w[i + 1:])) for x in by_rest.get(key, ()) if one_edit(x, w)} for w in count}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-count[x], x))
            if count[best] >= 10 * count[w]:
                form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None))
    return sorted(out)


def result(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_whole_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert result(QUERIES["op13_spelling"](spark, SF)) == brute([tuple(r) for r in rows])


@pytest.mark.parametrize("part", [20_000, 7])
def test_rows_of_any_kind(spark, words, part):
    """Nulls, repeated rows, chains of forms, a very long run, crowded blocks cut into slots."""
    rng = random.Random(2)
    chain = ["abcdefgh"] * 3000 + ["abcdefgx"] * 290 + ["abcdefxx"] * 28 + ["abcdexxx"] * 2
    text = " ".join(rng.choices(words, k=3000) + chain) + " Übermut Übermut üBERMUT ÜBERMUT"
    rows = [(1, text), (None, text), (1, text), (2, None), (3, ""), (4, "9" * 20), (5, "z" * 5000 + " " + "z" * 5001 + "_" + "z" * 5000), (6, "z" * 5001)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    got = result(spelling.variants(docs, params=spelling.Params(noise=31, part=part, held=50)))
    assert got == brute(rows)
    assert {w: root for w, _, root, *_ in got}["abcdexxx"] == "abcdefgh"


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect() == []
