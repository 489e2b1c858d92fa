"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

The n-grams' hashes are the global order. It is cut into fragments, the same ones for all
documents of a size class. Two sets with similarity t differ in at most
(1 - t) / (1 + t) * (|a| + |b|) n-grams; with more fragments than that, at least one fragment
is equal in both. So documents are compared only where a fragment of theirs is equal, and a
pair's overlap is the sum of its overlaps in the fragments: a fragment's is bounded from below
by parities of its n-grams first, and counted where the bound leaves the pair open.

1. Documents with equal sets are one node.
2. Nodes that share a fragment, and that sizes and parities let be linked, are connected;
   components of these edges hold every link.
3. A component that fits in a task is searched there. A larger one is first compared to its
   least node; those linked to it are one class, and only the others are compared, in blocks,
   to the blocks of the whole component. So a large group of near copies takes one pass, and no
   group is ever expanded into its pairs.
4. Components of the links found are the classes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abono.llm.graph import components
from abono.llm.store import stored
from abono.llm.text import (
    LOWER, SOLID, Piece, inner_runs, joined_hash, mixed, per_document, piece_of, ranges, running_hash, sliced, span_hash, words_of,
)


@dataclass(frozen=True)
class Params:
    words: int = 3
    #: Similarity as a fraction, so that ties are exact.
    least: Fraction = Fraction(9, 10)
    #: Growth from one size class to the next.
    step: float = 1.5
    #: n-grams of a component that one task compares; larger ones are cut into blocks.
    block: int = 4_000_000
    #: Fragments of a task's documents that are made distinct before the shuffle.
    hold: int = 1_000_000
    #: Nodes that share a fragment and are compared in one task.
    crowd: int = 5_000

    def differ(self, total: int) -> int:
        """n-grams in which linked sets of `total` elements together differ at most."""
        t = self.least
        return int(total * (1 - t) / (1 + t))

    def classes(self) -> tuple[np.ndarray, np.ndarray]:
        """Largest size, and number of fragments, of each size class."""
        top, tops = 1.0, []
        while top < 1 << 40:
            tops.append(int(top))
            top = max(top * self.step, top + 1)
        return np.array(tops), np.array([self._fragments(self.differ(2 * t)) for t in tops])

    @staticmethod
    def _fragments(differ: int) -> int:
        return differ + 1 + (differ + 6) // 7 if differ else 1


def sets_of(piece: Piece, p: Params, kept: np.ndarray = SOLID) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, and cuts. A text of fewer words, but not
    none, has one n-gram of all its words."""
    words = words_of(piece, kept)
    h = span_hash(running_hash(LOWER[piece.data]), words.start, words.end)
    starts, count = inner_runs(words.cuts, p.words)
    grams = joined_hash(h, p.words)[starts]
    text = np.repeat(np.arange(len(piece)), count)
    for i in np.flatnonzero((count == 0) & (np.diff(words.cuts) > 0)).tolist():
        own = h[words.cuts[i]:words.cuts[i + 1]]
        grams, text = np.append(grams, joined_hash(own, len(own))), np.append(text, i)
    order = np.argsort(grams, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[new], text[new]
    return grams, np.searchsorted(text, np.arange(len(piece) + 1))


def node_of(grams: np.ndarray) -> int:
    """Name of a set, from the hash of its elements."""
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _nodes(grams: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.array([node_of(grams[a:b]) for a, b in zip(cuts[:-1], cuts[1:])], dtype=np.int64)


def fragment_keys(grams: np.ndarray, cuts: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the non-empty fragments of each set, for the classes in which it can be
    linked: its own, and the next ones if a linked set may be that large. A set that fills more
    fragments than it may differ in from any linked set has one of those in common with each of
    them. The few others, which might only have empty ones in common, add their least n-grams, as
    many as hold one of every linked set's: two such sets have one of these in common."""
    tops, fragments = p.classes()
    n = np.diff(cuts)
    own = np.searchsorted(tops, n)
    largest = np.array([int(x / p.least) for x in n.tolist()], dtype=np.int64)
    texts, keys = [], []
    for plus in range(len(tops)):
        there = np.flatnonzero((n > 0) & ((plus == 0) | (largest > tops[np.maximum(own + plus - 1, 0)])))
        if not len(there):
            break
        kind = own[there] + plus
        at = ranges(cuts[there], n[there])
        text = np.repeat(there, n[there])
        parts, kinds = np.repeat(fragments[kind], n[there]).astype(np.uint64), np.repeat(kind, n[there])
        fragment = ((grams[at] >> np.uint64(32)) * parts) >> np.uint64(32)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (fragment[1:] != fragment[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        content = np.add.reduceat(mixed(grams[at]), first)
        texts.append(text[first])
        keys.append(mixed(content + mixed(fragment[first] + (kinds[first].astype(np.uint64) << np.uint64(40)))))
        filled = np.bincount(text[first], minlength=len(n))[there]
        total = n[there] + np.minimum(largest[there], tops[kind])
        few = filled <= [p.differ(x) for x in total.tolist()]
        bare, kind = there[few], kind[few]
        least = n[bare] + 1 + (-n[bare] * p.least.numerator) // p.least.denominator
        texts.append(np.repeat(bare, least))
        keys.append(mixed(mixed(grams[ranges(cuts[bare], least)]) + mixed(np.repeat(kind, least).astype(np.uint64) + np.uint64(1 << 60))))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *texts]), np.concatenate([none.view(np.uint64), *keys])


def _keyed(docs: DataFrame, text_col: str, p: Params) -> DataFrame:
    """(key, node), once per task (and `hold` rows) each."""
    def distinct(keys: list[np.ndarray], nodes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node = key[new], node[new]
        for at in range(0, len(key), 1 << 17):
            part = slice(at, at + (1 << 17))
            yield pa.RecordBatch.from_arrays([pa.array(key[part]), pa.array(node[part])], names=["key", "node"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        nodes: list[np.ndarray] = []
        for batch in batches:
            for _, piece in sliced(batch, 0):
                grams, cuts = sets_of(piece, p)
                own = _nodes(grams, cuts)
                text, key = fragment_keys(grams, cuts, p)
                keys.append(key.view(np.int64))
                nodes.append(own[text])
                if sum(map(len, keys)) > p.hold:
                    yield from distinct(keys, nodes)
                    keys, nodes = [], []
        if keys:
            yield from distinct(keys, nodes)

    return docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "key long, node long")


def sharing(docs: DataFrame, sets: DataFrame, text_col: str, p: Params) -> DataFrame:
    """(u, v): edges whose components hold every link. sets: (node, n_shingles, bits).

    Nodes that share a fragment are compared by sizes and parities, and those that may be
    linked are connected, as few edges as make them one. Fragments with the same nodes are
    compared once. Those with more nodes than p.crowd connect all to the least one, as no task
    compares them."""
    w = Window.partitionBy("key")
    name = F.pmod(F.xxhash64("node"), F.lit(1 << 44))
    rows = _keyed(docs, text_col, p).repartition("key").select(
        "key", "node", F.count("node").over(w).alias("n"), F.min("node").over(w).alias("low"), F.max("node").over(w).alias("high"),
        F.bit_xor(F.xxhash64("node")).over(w).alias("x"), F.try_sum(name).over(w).alias("s"))
    rows = stored(rows.where("low != high"), "shared")
    few = rows.where((F.col("n") <= p.crowd) & F.col("s").isNotNull())
    one = few.groupBy("n", "low", "high", "x", "s").agg(F.min("key").alias("key")).select("key")
    compared = few.join(one, "key", "left_semi").select("key", "node")
    marks = sets.select("node", "n_shingles", "bits").dropDuplicates(["node"])
    compared = compared.join(marks, "node").repartition("key").sortWithinPartitions("key")

    def group(part: pa.Table) -> pa.RecordBatch:
        nodes, first = np.unique(part["node"].to_numpy(), return_index=True)
        size = part["n_shingles"].to_numpy()[first]
        bits = np.frombuffer(b"".join(part["bits"].take(pa.array(first)).to_pylist()), dtype=np.uint64).reshape(-1, WIDE)
        label = np.arange(len(nodes))
        found = []
        for i in range(len(nodes)):
            for j in _plausible(i, np.flatnonzero(label[i + 1:] != label[i]) + i + 1, size, bits, p).tolist():
                if label[i] != label[j]:
                    found.append((int(nodes[i]), int(nodes[j])))
                    label[label == label[j]] = label[i]
        return _edges(found)

    edges = compared.mapInArrow(lambda batches: _by_group(batches, "key", group), "u long, v long")
    crowd = rows.where((F.col("n") > p.crowd) | F.col("s").isNull()).select(F.col("node").alias("u"), F.col("low").alias("v"))
    return edges.unionByName(crowd.where("u != v")).distinct()


def _plausible(i: int, rest: np.ndarray, size: np.ndarray, bits: np.ndarray, p: Params) -> np.ndarray:
    """Those of `rest` that sizes and parities let be linked with set i."""
    t = p.least
    small, large = np.minimum(size[rest], size[i]), np.maximum(size[rest], size[i])
    rest = rest[small * t.denominator >= large * t.numerator]
    if not len(rest):
        return rest
    apart = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1, dtype=np.int64)
    return rest[apart * (t.denominator + t.numerator) <= (size[rest] + size[i]) * (t.denominator - t.numerator)]


def linked(a: np.ndarray, b: np.ndarray, p: Params) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    t = p.least
    return both * t.denominator >= (len(a) + len(b) - both) * t.numerator


WIDE = 32


def parities(grams: np.ndarray, cuts: np.ndarray, wide: int = WIDE) -> np.ndarray:
    """64 * wide fragments' parities of each set: where they differ, so do the sets."""
    slot = (grams & np.uint64(64 * wide - 1)).astype(np.int64)
    out = np.zeros((len(cuts) - 1, wide), dtype=np.uint64)
    for i in range(len(cuts) - 1):
        odd = np.bincount(slot[cuts[i]:cuts[i + 1]], minlength=64 * wide).astype(np.uint8) & 1
        out[i] = np.packbits(odd, bitorder="little").view(np.uint64)
    return out


def links_among(sets: list[np.ndarray], others: list[np.ndarray] | None, group: list[int], more: list[int] | None, p: Params) -> list[tuple[int, int]]:
    """Links that join different groups, as few as make them one: (i, j) with j in `others`,
    or in sets if that is None. group and more are known classes of either."""
    every = sets + (others or [])
    label = np.array(group + (more or []), dtype=np.int64)
    size = np.array([len(s) for s in every], dtype=np.int64)
    cuts = np.concatenate([[0], np.cumsum(size)])
    # four slots per element of the largest set, so that long sets' parities tell as well
    wide = max(WIDE, 1 << int(size.max(initial=1) // 16).bit_length())
    while wide > WIDE and wide * len(every) > 1 << 22:  # 32 MB
        wide //= 2
    bits = parities(np.concatenate([np.zeros(0, np.uint64), *every]), cuts, wide)
    found = []
    base = 0 if others is None else len(sets)
    for i in range(len(sets)):
        low = i + 1 if others is None else base
        rest = _plausible(i, np.flatnonzero(label[low:] != label[i]) + low, size, bits, p)
        for j in rest.tolist():
            if label[i] != label[j] and linked(every[i], every[j], p):
                found.append((i, j - base))
                label[label == label[j]] = label[i]
    return found


def _sets_by_node(rows: pa.Table, p: Params) -> dict[int, np.ndarray]:
    """Sets of the rows' nodes, from texts; rows whose text has another set drop out."""
    out: dict[int, np.ndarray] = {}
    for batch in rows.to_batches():
        for part, piece in sliced(batch, batch.schema.get_field_index("t")):
            grams, cuts = sets_of(piece, p)
            for i, node in enumerate(part.column("node").to_pylist()):
                own = grams[cuts[i]:cuts[i + 1]]
                if node not in out and node_of(own) == node:
                    out[node] = own.copy()
    return out


def _by_group(batches: Iterator[pa.RecordBatch], key: str, f: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """f of the rows of each value of `key`, which come next to each other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        values = batch.column(key).to_pylist()
        cut = 0
        for i in range(len(values)):
            before = values[i - 1] if i else (held[-1].column(key)[-1].as_py() if held else values[0])
            if values[i] != before:
                if i > cut:
                    held.append(batch.slice(cut, i - cut))
                yield f(pa.Table.from_batches(held))
                held, cut = [], i
        if cut < len(values):
            held.append(batch.slice(cut))
    if held:
        yield f(pa.Table.from_batches(held))


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"u": pa.array([a for a, _ in pairs], pa.int64()), "v": pa.array([b for _, b in pairs], pa.int64())})


def _small(texts: DataFrame, p: Params) -> DataFrame:
    """Links within components that fit in a task. texts: (root, node, t)."""
    def group(rows: pa.Table) -> pa.RecordBatch:
        sets = _sets_by_node(rows, p)
        nodes = sorted(sets)
        found = links_among([sets[x] for x in nodes], None, list(range(len(nodes))), None, p)
        return _edges([(nodes[i], nodes[j]) for i, j in found])

    rows = texts.repartition("root").sortWithinPartitions("root")
    return rows.mapInArrow(lambda batches: _by_group(batches, "root", group), "u long, v long")


def _large(texts: DataFrame, p: Params) -> DataFrame:
    """Links within the other components. texts: (root, node, t, blocks)."""
    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, base = None, np.zeros(0, np.uint64)
        for batch in batches:
            for part, piece in sliced(batch, 2):
                grams, cuts = sets_of(piece, p)
                near = []
                for i, (root, pivot) in enumerate(zip(part.column(0).to_pylist(), part.column(3))):
                    if root != name:
                        name, base = root, sets_of(piece_of([pivot.as_py()]), p)[0]
                    near.append(linked(grams[cuts[i]:cuts[i + 1]], base, p))
                yield pa.RecordBatch.from_pydict({"root": part.column(0), "node": part.column(1), "near": near})

    pivots = texts.where("node = root").select("root", F.col("t").alias("pivot")).dropDuplicates(["root"])
    compared = texts.join(pivots, "root").select("root", "node", "t", "pivot").mapInArrow(star, "root long, node long, near boolean")
    near = stored(compared.dropDuplicates(["node"]), "near")
    first = near.where("near and node != root").select(F.col("node").alias("u"), F.col("root").alias("v"))

    # every other node meets all blocks of its component; a block meets all blocks of others
    apart = near.where("not near").groupBy("root").agg(F.count(F.lit(1)).alias("n_apart"))
    rows = texts.join(near.select("node", "near"), "node").join(apart, "root")
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumns({"block": block, "every": F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))})
    asking = rows.where("not near").select("root", "node", "t", "near", F.lit(True).alias("asks"), F.col("block").alias("i"), F.explode("every").alias("j"))
    asked = rows.select("root", "node", "t", "near", F.lit(False).alias("asks"), F.explode("every").alias("i"), F.col("block").alias("j"))
    pairs = asking.unionByName(asked).withColumn("task", F.struct("root", "i", "j"))

    def group(part: pa.Table) -> pa.RecordBatch:
        asks = np.array(part["asks"].to_pylist())
        if asks.all() or not asks.any():
            return _edges([])
        one, two = part.filter(pa.array(asks)), part.filter(pa.array(~asks))
        sets, others = _sets_by_node(one, p), _sets_by_node(two, p)
        left, right = sorted(sets), sorted(others)
        known = dict(zip(two["node"].to_pylist(), two["near"].to_pylist()))
        label = {x: k + 1 for k, x in enumerate(sorted({*left, *right}))}
        name = lambda x: 0 if known.get(x) else label[x]  # noqa: E731  those near the pivot are one class
        found = links_among([sets[x] for x in left], [others[x] for x in right], [name(x) for x in left], [name(x) for x in right], p)
        return _edges([(left[i], right[j]) for i, j in found])

    cut = pairs.repartition("task").sortWithinPartitions("task")
    rest = cut.mapInArrow(lambda batches: _by_group(batches, "task", group), "u long, v long")
    return first.unionByName(rest)


def nodes_of(docs: DataFrame, keep: list[str], *, text_col: str = "text", params: Params = Params()) -> DataFrame:
    """The columns `keep` of every row, the size of its set and the node that names it."""
    def make():
        def run(piece: Piece) -> dict[str, object]:
            grams, cuts = sets_of(piece, params)
            return {"n_shingles": np.diff(cuts), "node": _nodes(grams, cuts)}
        return run
    return per_document(docs, text_col, make, "n_shingles long, node long", keep)


def _texts(docs: DataFrame, id_col: str, text_col: str, p: Params) -> DataFrame:
    """(id, t, node): a text of each id and node, its own set's, once per task (and `hold`
    rows) each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[object, int]] = set()
        for batch in batches:
            for rows, piece in sliced(batch, 1):
                nodes, new = _nodes(*sets_of(piece, p)), []
                for i, pair in enumerate(zip(rows.column(0).to_pylist(), nodes.tolist())):
                    if pair not in seen:
                        seen.add(pair)
                        new.append(i)
                made = pa.RecordBatch.from_arrays([*rows.columns, pa.array(nodes)], names=["id", "t", "node"])
                yield made if len(new) == len(made) else made.take(pa.array(new, pa.int64()))
                if len(seen) > p.hold:
                    seen = set()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("node", T.LongType())]))


def jaccard_classes(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col, n_shingles (size of its set), node (hash that names
    its set), component_id, the least id that links reach, its own included, and root (a node
    that names its class; documents without words share one).

    Two documents link if the Jaccard similarity of their sets of n-grams is params.least or
    more. Null texts and those without words have empty sets and link with nothing; their
    component_id is their own id. Null ids count as larger than all others; a class of null
    ids alone has a null component_id. Repeated rows get a row each and are one class."""
    p = params

    def make():
        def run(piece: Piece) -> dict[str, object]:
            grams, cuts = sets_of(piece, p)
            marks = [x.tobytes() for x in parities(grams, cuts)]
            return {"n_shingles": np.diff(cuts), "node": _nodes(grams, cuts), "bits": marks}
        return run

    sets = stored(per_document(docs, text_col, make, "n_shingles long, node long, bits binary", [id_col]), "sets")
    groups = stored(components(sharing(docs, sets, text_col, p), "links"), "groups")

    nodes = sets.groupBy("node").agg(F.min(id_col).alias("id"), F.max("n_shingles").alias("n"))
    member = stored(groups.join(nodes, "node"), "members")
    weight = member.groupBy("root").agg(F.sum("n").alias("total"))
    blocks = F.ceil(F.col("total") / p.block)
    key = F.struct("node", "id").alias("key")
    member = member.join(weight, "root").select("root", "node", key, blocks.alias("blocks"))
    # the same join at every size: members grow with the documents
    texts = member.hint("merge").join(_texts(docs, id_col, text_col, p).select(key, "t"), "key")
    texts = texts.dropDuplicates(["key"]).select("root", "node", "t", "blocks")
    texts = stored(texts, "texts")
    links = _small(texts.where("blocks <= 1").select("root", "node", "t"), p)
    links = links.unionByName(_large(texts.where("blocks > 1"), p))
    classes = components(links, "links")

    rooted = nodes.join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("id").alias("least"))
    named = rooted.join(least, "root").select("node", "root", "least")
    joined = sets.join(named, "node")
    own = F.when(F.col("n_shingles") == 0, F.col(id_col)).otherwise(F.col("least"))
    return joined.select(id_col, "n_shingles", "node", own.alias("component_id"), "root")
