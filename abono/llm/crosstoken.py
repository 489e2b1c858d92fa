"""Alignment of two tokenizers' tokens over the same bytes, as an Arrow-native pipeline.

Every text is encoded by A (a byte-level merge model, which is given a space and the text) and
by B (a model of merged pieces, which puts the space there itself). Where a token of A and one
of B end at the same byte, both streams are cut; what lies between two cuts is a group. A token
of A and one of B whose bytes overlap are linked.

Texts are first cut into units: a space that follows a character other than white space begins
one. Neither tokenizer has a token across such a place (that of B is checked when it is
loaded), so a unit's tokens, groups and links are the same in every text that holds it, and each
distinct unit of a worker is encoded once. All further work is on Arrow tables of units:

- lists of ids are flattened, with the index of the unit that each id comes from;
- segmented cumulative sums of the tokens' byte lengths give the byte at which each one ends;
- an Acero full outer hash join of A's and B's tokens on (unit, end) has one row per link: its
  missing ids are those of the next token. Rows with both ids end a group;
- `Table.group_by` counts links per pair of ids in each task, and Spark adds these counts.

Counts are looked up in a second pass. Up to `Params.most_pairs` different pairs they are sent
to every task; beyond that, documents' pairs are joined with them by Spark.

Texts that are null, empty, or whose tokens' bytes are not the space and the text (B reads
U+2581 as a space) have no tokens."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from abono.llm.store import stored
from abono.llm.text import Piece, _quoted, ranges, sliced, sums_by

BLANK = "▁"
#: Characters of units that are encoded together, bytes of units whose tokens are aligned at once,
#: and bytes of text that are cut into units at once.
RUN = 1 << 14
SHARE = 1 << 18
PIECE = 1 << 22
#: Links that are counted at once.
MANY = 1 << 18


@dataclass(frozen=True)
class Params:
    #: So many different pairs are sent to every task, 24 bytes each; more are joined by Spark.
    most_pairs: int = 1 << 22
    #: Units that a worker remembers, and their bytes, before it begins anew.
    most_units: int = 1 << 19
    most_bytes: int = 1 << 25


@dataclass(frozen=True)
class Models:
    """Both models as the bytes of their files; the files are needed on the driver only."""

    a: bytes
    b: bytes

    @staticmethod
    def read(a: str, b: str) -> Models:
        with open(a, "rb") as left, open(b, "rb") as right:
            return Models(left.read(), right.read())


def byte_of_character() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others by
    characters from U+0100 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Pair:
    """Both tokenizers, with the bytes of each of their tokens by id."""

    def __init__(self, models: Models) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the threads
        self.a = Tokenizer.from_str(models.a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=models.b)
        to_byte = byte_of_character()
        names: list[bytes] = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab(with_added_tokens=False).items():
            names[i] = bytes(to_byte[c] for c in token)
        self.names_a = pa.array(names, pa.binary())
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b))]
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("a piece has a space after another character, so it may cross units")
        self.names_b = pa.array(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)],
            pa.binary())

    def encode(self, units: list[bytes]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of each unit; units begin with a space, and something follows it. Units that don't
        end in white space are encoded together, a run of them at a time, as neither tokenizer has
        a token across their borders; their ids are told apart by their bytes."""
        texts = [u.decode() for u in units]
        alone = np.array([t[-1].isspace() or BLANK in t for t in texts], dtype=bool)
        runs, size, run = [], 0, []
        for t in (texts[i] for i in np.flatnonzero(~alone)):
            run.append(t)
            size += len(t)
            if size > RUN:
                runs.append("".join(run))
                size, run = 0, []
        runs.append("".join(run))
        stops = np.cumsum([len(units[i]) for i in np.flatnonzero(~alone)], dtype=np.int64)
        own = [texts[i] for i in np.flatnonzero(alone)]
        order = pa.array(np.argsort(np.argsort(alone, kind="stable"), kind="stable"))
        out = []
        for together, single, names in ((self._by_a(runs), self._by_a(own), self.names_a), (self._by_b(runs), self._by_b(own), self.names_b)):
            flat = pa.array([i for ids in together for i in ids], pa.int32())
            ends = np.cumsum(pc.binary_length(pc.take(names, flat)).to_numpy(), dtype=np.int64)
            at = np.searchsorted(ends, stops)
            if len(at) and (at[-1] != len(ends) - 1 or not np.array_equal(ends[at], stops)):
                raise ValueError("a token crosses the border of a unit")
            cuts = np.concatenate([[0], at + 1]).astype(np.int32)
            lists = pa.concat_arrays([pa.ListArray.from_arrays(pa.array(cuts), flat), pa.array(single, pa.list_(pa.int32()))])
            out.append(lists.take(order))
        return out[0], out[1]

    def _by_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_b(self, texts: list[str]) -> list[list[int]]:
        return self.b.encode([t[1:] for t in texts], num_threads=1)


def ends(ids: pa.ListArray, names: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Of each token: its list, the byte of the list's text at which it ends, its id."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids).cast(pa.int64())
    whole = pc.cumulative_sum(pc.binary_length(pc.take(names, flat)).cast(pa.int64()))
    before = pa.concat_arrays([pa.array([0], pa.int64()), whole.combine_chunks() if isinstance(whole, pa.ChunkedArray) else whole])
    start = pc.take(before, pc.take(ids.offsets, parent))
    return parent, pc.subtract(whole, start), flat


def spelled(ids: pa.ListArray, names: pa.Array) -> pa.Array:
    """The bytes of each list's tokens together."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pc.take(names, pc.list_flatten(ids))), b"")


def link_rows(a: pa.ListArray, b: pa.ListArray, names_a: pa.Array, names_b: pa.Array) -> pa.Table:
    """One row per link of lists that spell the same bytes: parent, end, a, b, ends (both tokens
    end here), new_a and new_b (the row is its token's last), in order."""
    left = pa.table(dict(zip(("parent", "end", "a"), ends(a, names_a))))
    right = pa.table(dict(zip(("parent", "end", "b"), ends(b, names_b))))
    both = left.join(right, keys=["parent", "end"], join_type="full outer", use_threads=False)
    both = both.sort_by([("parent", "ascending"), ("end", "ascending")]).combine_chunks()
    new_a, new_b = pc.is_valid(both["a"]), pc.is_valid(both["b"])
    return pa.table({
        "parent": both["parent"], "end": both["end"],
        "a": pc.fill_null_backward(both["a"]), "b": pc.fill_null_backward(both["b"]),
        "ends": pc.and_(new_a, new_b), "new_a": new_a, "new_b": new_b})


def _joined_runs(run: pa.ChunkedArray, texts: pa.ChunkedArray, between: str) -> tuple[pa.Array, pa.Array]:
    """Neighbouring texts of equal `run`, joined; and each such run."""
    coded = pc.run_end_encode(run.combine_chunks())
    coded = coded.chunk(0) if isinstance(coded, pa.ChunkedArray) else coded
    cuts = pa.concat_arrays([pa.array([0], pa.int32()), coded.run_ends.cast(pa.int32())])
    lists = pa.ListArray.from_arrays(cuts, texts.combine_chunks())
    return pc.binary_join(lists, pa.scalar(between, lists.type.value_type)), coded.values


def group_texts(links: pa.Table) -> tuple[pa.Array, pa.Array]:
    """(text, parent): groups of each parent as `a1,a2|b1;a3|b2,b3`."""
    closed = pc.cumulative_sum(links["ends"].cast(pa.int64()))
    number = pc.subtract(closed, links["ends"].cast(pa.int64()))
    sides = []
    for side in "ab":
        own = links[f"new_{side}"]
        text, _ = _joined_runs(number.filter(own), links[side].filter(own).cast(pa.string()), ",")
        sides.append(text)
    text = pc.binary_join_element_wise(*sides, "|").cast(pa.large_string())
    return _joined_runs(links["parent"].filter(links["ends"]), pa.chunked_array([text]), ";")


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int64) << 32) | b


def counted(links: pa.Table, weight: pa.Array) -> pa.Table:
    """(a, b, n): the links of each pair of ids, each counted as often as its parent's weight."""
    def added(rows: pa.Table) -> pa.Table:
        return rows.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).rename_columns(["a", "b", "n"])

    total = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]).empty_table()
    for first in range(0, links.num_rows, MANY):
        part = links.slice(first, MANY)
        n = pc.take(weight, part["parent"])
        rows = pa.table({"a": part["a"], "b": part["b"], "n": n}).filter(pc.greater(n, 0))
        total = added(pa.concat_tables([total, added(rows)]))
    return total


def unit_starts(piece: Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of a piece, a space before each that isn't empty, as (bytes, starts of units, first
    unit of each text)."""
    size = np.diff(piece.offsets)
    filled = size > 0
    offsets = np.concatenate([[0], np.cumsum(size + filled)])
    data = np.full(int(offsets[-1]), 32, dtype=np.uint8)
    if data.size:
        body = np.ones(len(data), dtype=bool)
        body[offsets[:-1][filled]] = False
        data[body] = piece.data
    if len(data) < 3:
        cut = np.zeros(len(data), dtype=bool)
    else:
        # A space whose neighbour on the left is no white space, and which is not a text's last byte.
        one, two = data[:-1], np.concatenate([[0], data[:-2]])
        ascii_blank = (one == 32) | ((one >= 9) & (one <= 13)) | ((one >= 28) & (one <= 31))
        # Last bytes of U+0085, U+00A0, U+1680, U+2000 to U+200A, U+2028, U+2029, U+202F, U+205F, U+3000.
        tail = ((one >= 0x80) & (one <= 0x8A)) | np.isin(one, [0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
        wide_blank = tail & np.isin(two, [0xC2, 0x80, 0x81, 0x9A])
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (data[1:] == 32) & ~ascii_blank & ~wide_blank
        cut[offsets[1:][filled] - 1] = False
    cut[offsets[:-1][filled]] = True
    starts = np.flatnonzero(cut)
    return data, starts, np.searchsorted(starts, offsets)


class Units:
    """Distinct units that a worker has met, with their tokens, links and groups."""

    def __init__(self, pair: Pair) -> None:
        self.pair = pair
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.bytes = 0
        self.links = pa.schema([("parent", pa.int32()), ("a", pa.int32()), ("b", pa.int32())]).empty_table()
        self.sizes = pa.schema([(c, pa.int32()) for c in ("n_a", "n_b", "n_groups", "n_links", "valid")]).empty_table()
        self.texts = pa.array([], pa.large_string())

    def add(self, units: list[bytes]) -> None:
        """Adds units that are not there yet, a share of about SHARE bytes at a time, as tokens and
        joined rows take many times the bytes of their units."""
        base = len(self.index)
        size = np.cumsum([len(u) for u in units], dtype=np.int64)
        for i, u in enumerate(units):
            self.index[u] = base + i
        self.bytes += int(size[-1])
        made, first = [], 0
        while first < len(units):
            last = max(first + 1, int(np.searchsorted(size, (size[first - 1] if first else 0) + SHARE, side="right")))
            made.append(self._aligned(units[first:last], base + first))
            first = last
        links, sizes, texts = zip(*made)
        self.links = pa.concat_tables([self.links, *links]).combine_chunks()
        self.sizes = pa.concat_tables([self.sizes, *sizes]).combine_chunks()
        self.texts = pa.concat_arrays([self.texts, *texts])
        del made, links, sizes, texts
        pa.default_memory_pool().release_unused()

    def _aligned(self, units: list[bytes], base: int) -> tuple[pa.Table, pa.Table, pa.Array]:
        """Links, sizes and groups of units that are numbered from `base` on."""
        a, b = self.pair.encode(units)
        own = pa.array(units, pa.binary())
        same = pc.and_(pc.equal(spelled(a, self.pair.names_a), own), pc.equal(spelled(b, self.pair.names_b), own))
        valid = np.asarray(same)
        places = pa.array(np.flatnonzero(valid))
        a, b = a.take(places), b.take(places)
        n_groups, n_links = (np.zeros(len(units), np.int32) for _ in range(2))
        n_a, n_b = n_groups.copy(), n_groups.copy()
        texts = pa.array([""] * len(units), pa.large_string())
        new = self.links.schema.empty_table()
        if len(places):
            links = link_rows(a, b, self.pair.names_a, self.pair.names_b)
            parent = np.asarray(places)[links["parent"].to_numpy()]
            n_groups[:] = np.bincount(parent[links["ends"].to_numpy()], minlength=len(units))
            n_links[:] = np.bincount(parent, minlength=len(units))
            n_a[valid], n_b[valid] = pc.list_value_length(a).to_numpy(), pc.list_value_length(b).to_numpy()
            text, _ = group_texts(links)
            texts = pc.replace_with_mask(texts, same, text)
            new = pa.table({"parent": (parent + base).astype(np.int32), "a": links["a"], "b": links["b"]})
        sizes = pa.table({"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "valid": valid.astype(np.int32)})
        return new, sizes, texts

    def find(self, data: np.ndarray, starts: np.ndarray) -> pa.Array:
        """The number of every unit; new ones are added."""
        cuts = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, cuts, pa.py_buffer(data)])
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        fresh = [u for u in distinct if u not in self.index]
        if fresh:
            self.add(fresh)
        return pc.take(pa.array([self.index[u] for u in distinct], pa.int64()), coded.indices)


_workers: dict[str, Units] = {}


def units_of(models: Models) -> Units:
    """The same units for all tasks of a worker."""
    name = hashlib.sha256(models.a + models.b).hexdigest()
    if name not in _workers:
        _workers.clear()
        _workers[name] = Units(Pair(models))
    return _workers[name]


@dataclass
class Texts:
    """Units of the texts of a piece: their numbers, each one's text, and which texts count."""

    unit: pa.Array
    parent: np.ndarray
    cuts: np.ndarray
    valid: np.ndarray

    def sums(self, table: pa.Table) -> dict[str, np.ndarray]:
        """Sums over each text's units of all columns of a table with a row per unit; 0 for texts
        without tokens."""
        unit = np.asarray(self.unit)
        return {c: np.where(self.valid, sums_by(table[c].to_numpy()[unit], self.cuts), 0) for c in table.column_names}


def read_texts(units: Units, piece: Piece) -> Texts:
    data, starts, cuts = unit_starts(piece)
    unit = units.find(data, starts) if len(starts) else pa.array([], pa.int64())
    count = np.diff(cuts)
    parent = np.repeat(np.arange(len(count)), count)
    wrong = np.asarray(units.sizes["valid"])[np.asarray(unit)] == 0
    valid = count > 0
    valid[parent[wrong]] = False
    return Texts(unit, parent, cuts, valid)


def _rested(units: Units, params: Params) -> bool:
    return len(units.index) > params.most_units or units.bytes > params.most_bytes


def pair_counts(docs: DataFrame, models: Models, text_col: str = "text", params: Params = Params()) -> DataFrame:
    """(a, b, n): how many links of all texts hold the pair of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(models)
        seen = np.zeros(0, np.int64)

        def flushed() -> Iterator[pa.RecordBatch]:
            weight = np.zeros(len(units.index), np.int64)
            weight[:len(seen)] = seen
            yield from counted(units.links, pa.array(weight)).to_batches(max_chunksize=100_000)

        for batch in batches:
            for _, piece in sliced(batch, 0, PIECE):
                texts = read_texts(units, piece)
                used = np.asarray(texts.unit)[texts.valid[texts.parent]]
                more = np.bincount(used, minlength=len(units.index))
                more[:len(seen)] += seen
                seen = more
                if _rested(units, params):
                    yield from flushed()
                    units.clear()
                    seen = np.zeros(0, np.int64)
        yield from flushed()

    kind = T.StructType.fromDDL("a int, b int, n long")
    partial = docs.select(F.col(_quoted(text_col)).cast("string").alias("text")).mapInArrow(run, kind)
    return partial.groupBy("a", "b").agg(F.sum("n").alias("n"))


def best_marked(counts: DataFrame) -> DataFrame:
    """counts with best: whether no other id of A has more links with this id of B. There are at
    most as many ids as B has pieces, so their maxima are broadcast."""
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    return counts.join(F.broadcast(top), "b").select("a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


SIZES = "n_a long, n_b long, n_groups long, n_links long"


def _per_text(docs: DataFrame, text_col: str, keep: Sequence[str], fields: str, models: Models, params: Params,
              begin: Callable[[Units], Callable[[Units, Texts], dict[str, object]]]) -> DataFrame:
    """The columns `keep`, `fields` and the groups of every row."""
    new = T.StructType.fromDDL(f"{SIZES}, groups string, {fields}")
    kinds = [to_arrow_type(f.dataType) for f in new]
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = units_of(models)
        more = begin(units)
        for batch in batches:
            for rows, piece in sliced(batch, n, PIECE):
                texts = read_texts(units, piece)
                made: dict[str, object] = texts.sums(units.sizes.drop_columns(["valid"]))
                cuts = pa.array(texts.cuts.astype(np.int32))
                whole = pc.binary_join(pa.ListArray.from_arrays(cuts, pc.take(units.texts, texts.unit)), pa.scalar(";", pa.large_string()))
                made["groups"] = pc.if_else(pa.array(texts.valid), whole, "").cast(pa.string())
                made |= more(units, texts)
                columns = [v if isinstance(v := made[f.name], pa.Array) else pa.array(v, kind) for f, kind in zip(new, kinds)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:n], *columns], names=[*keep, *new.names])
                if _rested(units, params):
                    units.clear()
                    more = begin(units)

    text = F.col(_quoted(text_col)).cast("string").alias("__text")
    schema = T.StructType([*[docs.schema[c] for c in keep], *new.fields])
    return docs.select(*[F.col(_quoted(c)) for c in keep], text).mapInArrow(run, schema)


def _looked_up(docs: DataFrame, text_col: str, keep: Sequence[str], models: Models, counts: DataFrame, params: Params) -> DataFrame:
    """With counts sent to every task, by pair: Params.most_pairs at most. A worker
    may remember units of other texts, whose pairs have none."""
    table = counts.toArrow()
    pair = pair_keys(table["a"].to_numpy(), table["b"].to_numpy())
    order = np.argsort(pair)
    # last a row for pairs without counts, beyond all keys
    table = pa.table({
        "pair": np.append(pair[order], np.iinfo(np.int64).max), "n": np.append(table["n"].to_numpy()[order], 0),
        "best": np.append(table["best"].to_numpy()[order].astype(np.int8), np.int8(0))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    sent = docs.sparkSession.sparkContext.broadcast(sink.getvalue().to_pybytes())

    def begin(units: Units) -> Callable[[Units, Texts], dict[str, object]]:
        known = pa.ipc.open_stream(sent.value).read_all()
        pairs, counts, best = (known[c].to_numpy() for c in ("pair", "n", "best"))
        scores = pa.schema([("n_best", pa.int64()), ("count_sum", pa.int64())]).empty_table()

        def more(units: Units, texts: Texts) -> dict[str, object]:
            nonlocal scores
            done, n = scores.num_rows, len(units.index)
            if done < n:
                of = units.links["parent"].to_numpy()
                links = units.links.slice(int(np.searchsorted(of, done)))
                key = pair_keys(links["a"].to_numpy(), links["b"].to_numpy())
                at = np.searchsorted(pairs[:-1], key)
                at[pairs[at] != key] = len(pairs) - 1
                cuts = np.searchsorted(links["parent"].to_numpy(), np.arange(done, n + 1))
                new = pa.table({"n_best": sums_by(best[at], cuts), "count_sum": sums_by(counts[at], cuts)})
                scores = pa.concat_tables([scores, new]).combine_chunks()
            return texts.sums(scores)

        return more

    return _per_text(docs, text_col, keep, "n_best long, count_sum long", models, params, begin)


def _joined(docs: DataFrame, text_col: str, keep: Sequence[str], models: Models, counts: DataFrame, params: Params) -> DataFrame:
    """With each document's pairs joined with the counts, any number of them."""

    def begin(units: Units) -> Callable[[Units, Texts], dict[str, object]]:
        def more(units: Units, texts: Texts) -> dict[str, object]:
            of = units.links["parent"].to_numpy()
            first, last = np.searchsorted(of, np.arange(len(units.index))), np.searchsorted(of, np.arange(len(units.index)), side="right")
            on = texts.valid[texts.parent]
            unit, parent = np.asarray(texts.unit)[on], texts.parent[on]
            count = (last - first)[unit]
            links = units.links.take(pa.array(ranges(first[unit], count)))
            rows = pa.table({"text": np.repeat(parent, count), "a": links["a"], "b": links["b"]})
            found = rows.group_by(["text", "a", "b"], use_threads=False).aggregate([([], "count_all")]).sort_by("text").combine_chunks()
            cuts = np.searchsorted(found["text"].to_numpy(), np.arange(len(texts.valid) + 1)).astype(np.int32)
            parts = [found[c].combine_chunks() if found.num_rows else pa.array([], found[c].type) for c in ("a", "b", "count_all")]
            structs = pa.StructArray.from_arrays(parts, names=["a", "b", "m"])
            return {"pairs": pa.ListArray.from_arrays(pa.array(cuts), structs)}
        return more

    numbered = docs.select(*[F.col(_quoted(c)) for c in dict.fromkeys([*keep, text_col])], F.monotonically_increasing_id().alias("__row"))
    rows = stored(_per_text(numbered, text_col, [*keep, "__row"], "pairs array<struct<a:int,b:int,m:long>>", models, params, begin), "token-pairs")
    pairs = rows.select("__row", F.explode("pairs").alias("p")).select("__row", "p.a", "p.b", "p.m")
    found = pairs.join(counts, ["a", "b"]).groupBy("__row").agg(
        F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(found, "__row", "left").select(
        *[F.col(_quoted(c)) for c in keep], "n_a", "n_b", "n_groups", "n_links", "groups",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def aligned(docs: DataFrame, models: Models, text_col: str = "text", keep: Sequence[str] = ("doc_id",), params: Params = Params()) -> DataFrame:
    """A row per row of docs: the columns `keep` and

    - n_a, n_b, n_groups, n_links: its tokens of A and of B, groups, and linked pairs of them;
    - groups: `a1,a2|b1;a3|b2,b3`, the ids of its groups in order;
    - n_best: links whose pair of ids has the most links, over all texts, of the pairs with the
      same id of B, ties included; count_sum: the sum, over links, of their pairs' counts.

    Ids need not be unique, nor set; repeated rows are rows of their own and all count. Null and
    empty texts, and those that the tokens don't spell, have zeros and no groups. Other columns of
    docs are not read, so their names can't clash; those in `keep` must differ from the results'.
    A text is never cut but at units, so a text without spaces is encoded as a whole."""
    counts = stored(best_marked(stored(pair_counts(docs, models, text_col, params), "pair-sums")), "pair-counts")
    few = counts.limit(params.most_pairs + 1).count() <= params.most_pairs
    return (_looked_up if few else _joined)(docs, text_col, keep, models, counts, params)


def groups_digest(rows: DataFrame) -> DataFrame:
    """groups as their sha256; empty where there are none."""
    return rows.select(
        *[c for c in rows.columns if c != "groups"],
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"))
