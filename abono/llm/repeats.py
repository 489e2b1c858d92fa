"""Removal of repeated passages by longest-previous-factor arrays over suffixes.

A passage is repeated if a window of `length` bytes also starts elsewhere. To find such windows
without sorting all suffixes of all texts together, every window is assigned to an anchor: the
least hash among its grams of some bytes. Equal windows have the same anchor at the same
offset, so only strings around equal grams need be compared.

1. Each text is cut into anchored strings: neighbouring windows with one anchor. A row of
   hashes stands for each.
2. Grams that occur once drop out. Where all strings around a gram are equal, every window in
   them is repeated. The rest go on, one string for each different one.
3. Only those strings' bytes are fetched, and grouped by gram. Suffix order by prefix doubling
   and previous and next smaller positions in it tell which windows have an earlier match, and
   with positions negated which have a later one.
4. Grams with very many different strings are split: their windows are compared by hash, in
   an aggregate that any number of tasks share.

Offsets are in bytes of UTF-8."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abono.llm.store import stored
from abono.llm.text import Piece, arrow_piece, list_array, mixed, piece_of, ranges, running_hash, sliced, span_hash


@dataclass(frozen=True)
class Params:
    length: int = 200
    gram: int = 32
    #: Different strings around one gram that one task compares; grams with more are split.
    group: int = 20_000
    #: Bytes that are put in suffix order at once, but whole groups.
    batch: int = 1 << 21


def anchors(piece: Piece, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each maximal run of neighbouring windows of one text whose least gram hash is the
    same one (the leftmost of equal ones): its first and last window, and the gram's hash."""
    n, wide = len(piece.data), length - gram + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none
    at = np.arange(n - gram + 1)
    low = h = span_hash(running_hash(piece.data), at, at + gram)
    best, size = np.arange(len(h), dtype=np.int32), 1
    while size < wide:
        step = min(size, wide - size)
        right = low[step:] < low[:-step]
        best = np.where(right, best[step:], best[:-step])
        low = np.where(right, low[step:], low[:-step])
        size += step
    count = np.maximum(np.diff(piece.offsets) - length + 1, 0)
    start = ranges(piece.offsets[:-1], count)
    if not len(start):
        return none, none, none
    place = best[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], start[last], h[place[first]].view(np.int64)


def anchored_strings(docs: DataFrame, p: Params) -> DataFrame:
    """docs: (__id, __th, __text). A row per anchored string: gram hash, string hash, and the
    starts of its first and last window in the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, piece in sliced(batch, 2, 1 << 19):
                first, last, key = anchors(piece, p.length, p.gram)
                view = memoryview(piece.data)
                whole = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + p.length).tolist())]
                text = np.searchsorted(piece.offsets, first, side="right") - 1
                at = pa.array(text)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(at), rows.column(1).take(at), pa.array(key), pa.array(np.array(whole, dtype=np.uint64).view(np.int64)),
                    pa.array((first - piece.offsets[text]).astype(np.int32)), pa.array((last - piece.offsets[text]).astype(np.int32)),
                ], names=["__id", "__th", "key", "whole", "a", "z"])

    kind = docs.schema["__id"].dataType.simpleString()
    return docs.mapInArrow(run, f"__id {kind}, __th binary, key long, whole long, a int, z int")


def window_order(data: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of the windows at `start`, of equal ones by place, and each window's class:
    equal windows have one class, and classes rise in suffix order. Prefix doubling: the rank
    of 2 m bytes comes from the ranks of m bytes at both halves."""
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)])
    size = 8
    while size > length:
        size //= 2
    wide = np.zeros(len(data), dtype=np.uint64)
    for j in range(size):
        wide = (wide << np.uint64(8)) | padded[j:j + len(data)]
    rank = np.unique(wide, return_inverse=True)[1].astype(np.int64)
    while size * 2 <= length:
        after = np.zeros(len(rank), dtype=np.int64)
        after[:-size] = rank[size:] + 1
        rank = np.unique(rank * (len(rank) + 1) + after, return_inverse=True)[1].astype(np.int64)
        size *= 2
    pair = rank[start] * (len(rank) + 1) + rank[start + length - size]
    order = np.argsort(pair, kind="stable")
    classes = np.zeros(len(start), dtype=np.int64)
    classes[order[1:]] = np.cumsum(pair[order[1:]] != pair[order[:-1]])
    return order, classes


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the nearest one before it with a smaller value, -1 if none. All places
    jump at once: what lies between a place and its pointer is larger, so a pointer that is
    larger too can be replaced by that one's pointer."""
    to = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(to >= 0)
    while len(open_):
        open_ = open_[values[to[open_]] > values[open_]]
        to[open_] = to[to[open_]]
        open_ = open_[to[open_] >= 0]
    return to


def earlier_match(order: np.ndarray, classes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each window's longest previous factor is a whole window: whether in suffix
    order the nearest window before or after it with a smaller place is equal to it."""
    at, kind = place[order], classes[order]
    before = previous_smaller(at)
    after = len(at) - 1 - previous_smaller(at[::-1])[::-1]
    same = (before >= 0) & (kind[before] == kind)
    inside = after < len(at)
    same |= inside & (kind[np.where(inside, after, 0)] == kind)
    out = np.zeros(len(at), dtype=bool)
    out[order] = same
    return out


def spans_of(marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes covered by windows at the rising places `marked`, as maximal spans."""
    if not len(marked):
        return marked, marked
    new = np.ones(len(marked), dtype=bool)
    new[1:] = marked[1:] > marked[:-1] + length
    first = np.flatnonzero(new)
    return marked[first], marked[np.append(first[1:], len(marked)) - 1] + length


def compare(strings: list[bytes], p: Params, keep_first: bool) -> list[np.ndarray]:
    """For each string, in text order, the repeated windows (those with an earlier match if
    the first one stays)."""
    piece = piece_of(strings)
    size = np.diff(piece.offsets)
    start = ranges(piece.offsets[:-1], size - p.length + 1)
    owner = np.repeat(np.arange(len(strings)), size - p.length + 1)
    order, classes = window_order(piece.data, start, p.length)
    found = earlier_match(order, classes, start)
    if not keep_first:
        found |= earlier_match(order[::-1], classes, -start)
    cuts = np.searchsorted(owner[found], np.arange(len(strings) + 1))
    place = start[found] - piece.offsets[owner[found]]
    return [place[cuts[i]:cuts[i + 1]] for i in range(len(strings))]


def plausible(strings: list[bytes], keys: np.ndarray, p: Params) -> np.ndarray:
    """Strings that may share a window with another of the same gram. A shared window holds
    the gram and, on one side of it at least, half of the other bytes."""
    piece = piece_of(strings)
    grams, offsets = len(piece.data) - p.gram + 1, piece.offsets
    half = (p.length - p.gram) // 2
    at = np.arange(grams)
    running = running_hash(piece.data)
    h = span_hash(running, at, at + p.gram).view(np.int64)
    owner = np.repeat(np.arange(len(strings)), np.diff(offsets))[:grams]
    hit = np.flatnonzero(h == keys[owner])
    # the anchor lies in every window of the string, so in its last window; the first such
    # gram there is the anchor
    hit = hit[hit >= offsets[owner[hit] + 1] - p.length]
    owners, where = np.unique(owner[hit], return_index=True)
    place = np.zeros(len(strings), dtype=np.int64)
    place[owners] = hit[where]
    twice = np.zeros(len(strings), dtype=bool)
    for low, high in ((place - half, place + p.gram), (place, place + p.gram + half)):
        fits = (low >= offsets[:-1]) & (high <= offsets[1:])
        side = span_hash(running, np.where(fits, low, 0), np.where(fits, high, 0)) ^ mixed(keys.view(np.uint64))
        _, back, count = np.unique(side[fits], return_inverse=True, return_counts=True)
        twice[np.flatnonzero(fits)[count[back] > 1]] = True
    return twice


def compared(strings: DataFrame, p: Params, keep_first: bool) -> DataFrame:
    """strings: (key, whole, first, body) of grams that fit in a task. (key, whole, spans)
    with the removed bytes of each as start, end, start, end ..."""
    def batches_of_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            cut = 0
            while len(keys):
                body = arrow_piece(batch.column("body"))
                room = int(np.searchsorted(body.offsets[cut:] - body.offsets[cut], p.batch - size, side="right")) + cut - 1
                room = max(room, cut)
                if room >= len(keys):
                    held.append(batch.slice(cut))
                    size += int(body.offsets[-1] - body.offsets[cut])
                    break
                # a batch ends where a group ends
                more = np.flatnonzero(keys[max(room, 1):] != keys[max(room, 1) - 1:-1])
                if not len(more):
                    held.append(batch.slice(cut))
                    size += int(body.offsets[-1] - body.offsets[cut])
                    break
                end = max(room, 1) + int(more[0])
                held.append(batch.slice(cut, end - cut))
                yield pa.Table.from_batches(held)
                held, size, cut = [], 0, end
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches_of_groups(batches):
            table = table.append_column("row", pa.array(np.arange(table.num_rows)))
            # texts that several rows have bring a string several times
            one = table.group_by(["key", "whole"]).aggregate([("row", "min")])["row_min"].to_numpy()
            table = table.take(pa.array(np.sort(one)))
            keys, body = table["key"].to_numpy(), table["body"].to_pylist()
            rows = np.flatnonzero(plausible(body, keys, p))
            if not len(rows):
                continue
            # text order: the order of first occurrences
            some = table.set_column(table.schema.get_field_index("row"), "row", pa.array(np.arange(len(keys)))).take(pa.array(rows))
            by_text = [(name, "ascending") for name in ("id", "th", "a")]
            rank = some.take(pc.sort_indices(some, sort_keys=by_text, null_placement="at_start"))
            rows = rank["row"].to_numpy()
            found = compare([body[i] for i in rows.tolist()], p, keep_first)
            spans, cuts = [], [0]
            for windows in found:
                spans.append(np.stack(spans_of(windows, p.length), axis=1).reshape(-1))
                cuts.append(cuts[-1] + len(spans[-1]))
            yield pa.RecordBatch.from_arrays([
                pa.array(keys[rows]), pa.array(table["whole"].to_numpy()[rows]),
                list_array(np.concatenate(spans), np.array(cuts), pa.int32())], names=["key", "whole", "spans"])

    rows = strings.repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "key long, whole long, spans array<int>")


def split_windows(strings: DataFrame, p: Params, keep_first: bool) -> DataFrame:
    """The same for grams of any number of strings: windows as hashes, counted by Spark."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, piece in sliced(batch, 5, 1 << 19):
                size = np.diff(piece.offsets) - p.length + 1
                start = ranges(piece.offsets[:-1], size)
                owner = pa.array(np.repeat(np.arange(len(piece)), size))
                running = running_hash(piece.data)
                middle = start + p.length // 2
                h = span_hash(running, start, start + p.length), span_hash(running, start, middle)
                yield pa.RecordBatch.from_arrays([
                    *[rows.column(k).take(owner) for k in range(5)], pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)),
                    pa.array((start - np.repeat(piece.offsets[:-1], size)).astype(np.int32))],
                    names=["key", "whole", "id", "th", "a", "h1", "h2", "w"])

    kind = strings.schema["id"].dataType.simpleString()
    rows = strings.select("key", "whole", "id", "th", "a", "body").mapInArrow(windows, f"key long, whole long, id {kind}, th binary, a int, h1 long, h2 long, w int")
    rows = rows.withColumn("first", F.struct("id", "th", (F.col("a") + F.col("w")).alias("a")))
    same = rows.groupBy("key", "h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("least"))
    hit = rows.join(same.where("n > 1"), ["key", "h1", "h2"])
    if keep_first:
        hit = hit.where(F.col("first") != F.col("least"))
    merged = hit.groupBy("key", "whole").agg(F.sort_array(F.collect_list("w")).alias("w"))
    pairs = F.flatten(F.transform("w", lambda w: F.array(w, w + p.length)))
    return merged.select("key", "whole", pairs.alias("spans"))


def bodies(docs: DataFrame, wanted: DataFrame, p: Params) -> DataFrame:
    """wanted: (key, whole, id, th, a, z), each with its bytes from one of its texts."""
    asked = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("key", "whole", "a", "z")).alias("asked"))
    texts = docs.select(F.col("__id").alias("id"), F.col("__th").alias("th"), "__text")
    same = texts["id"].eqNullSafe(asked["id"]) & (texts["th"] == asked["th"])
    rows = asked.hint("merge").join(texts, same).select(asked["id"], asked["th"], F.inline("asked"), F.col("__text").cast("binary").alias("t"))
    body = F.substring("t", F.col("a") + 1, F.col("z") - F.col("a") + p.length)
    return rows.select("key", "whole", "id", "th", "a", body.alias("body"))


def removed_spans(docs: DataFrame, p: Params, keep_first: bool) -> DataFrame:
    """docs: (__id, __th, __text). (__id, __th, spans) with a row per text that loses bytes;
    spans are start, end, start, end ..., unordered and overlapping."""
    strings = anchored_strings(docs, p)
    seen = strings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), (F.min("whole") != F.max("whole")).alias("mixed"))
    # the same joins at every size: what is joined grows with the documents
    again = stored(strings.join(seen.where("n > 1").select("key", "mixed").hint("merge"), "key"), "again")

    occurrence = F.struct(F.col("__id").alias("id"), F.col("__th").alias("th"), "a", "z")
    kinds = again.where("mixed") if not keep_first else again
    kinds = stored(kinds.groupBy("key", "whole", "mixed").agg(F.count(F.lit(1)).alias("n"), F.min(occurrence).alias("first")), "kinds")
    wanted = kinds.where("mixed").select("key", "whole", "first.*")
    crowd = wanted.groupBy("key").count().where(F.col("count") > p.group).select("key")
    fetched = stored(bodies(docs, wanted, p), "strings")
    usual = compared(fetched.join(crowd, "key", "left_anti"), p, keep_first)
    crowded = split_windows(fetched.join(crowd, "key", "left_semi").dropDuplicates(["key", "whole"]), p, keep_first)
    partial = usual.unionByName(crowded)

    whole = F.array(F.col("a"), F.col("z") + p.length)
    moved = F.transform("spans", lambda x: x + F.col("a"))
    known = kinds.join(partial, ["key", "whole"], "left").select("key", "whole", "n", "first", "spans")
    if keep_first:
        rows = again.join(known, ["key", "whole"])
        is_first = F.col("__id").eqNullSafe(F.col("first.id")) & (F.col("__th") == F.col("first.th")) & (F.col("a") == F.col("first.a"))
        rows = rows.select("__id", "__th", F.when(~is_first, whole).otherwise(moved).alias("spans"))
    else:
        sure = again.where("not mixed").select("__id", "__th", whole.alias("spans"))
        rest = again.where("mixed").join(known.where("n > 1 or spans is not null"), ["key", "whole"])
        rows = sure.unionByName(rest.select("__id", "__th", F.when(F.col("n") > 1, whole).otherwise(moved).alias("spans")))
    rows = rows.where("size(spans) > 0")
    return rows.groupBy("__id", "__th").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def merged_spans(flat: np.ndarray) -> np.ndarray:
    """Rows of start and end, maximal and rising."""
    if not len(flat):
        return np.zeros((0, 2), np.int64)
    pairs = np.asarray(flat, dtype=np.int64).reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = pairs[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack([pairs[first, 0], reach[np.append(first[1:], len(pairs)) - 1]], axis=1)


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_first: bool = True,
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col, n_bytes, removed (array of start and end in bytes) and
    kept (the remaining bytes). A byte is removed if a window of params.length bytes that
    covers it also starts earlier (keep_first) or anywhere else in the documents.

    Earlier means a lower id, of equal ids a lower hash of the text, of equal texts a lower
    place; rows alike in id and text lose and keep the same. A text is named by its id and 128 bits
    of hash, so null or repeated ids don't mix texts up. Null and empty texts, and those
    shorter than a window, lose nothing. Null ids come first."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.unhex(F.md5(text.cast("binary"))).alias("__th"), text.alias("__text"))
    spans = removed_spans(rows, params, keep_first)
    same = rows["__id"].eqNullSafe(spans["__id"]) & (rows["__th"] == spans["__th"])
    joined = rows.join(spans.hint("merge"), same, "left").select(rows["__id"], F.col("__text").cast("binary").alias("t"), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, piece in sliced(batch, 1):
                lists = part.column(2)
                removed, kept = [], []
                for i, flat in enumerate(lists):
                    text = piece.text(i)
                    pairs = merged_spans(flat.values.to_numpy()) if flat.is_valid else np.zeros((0, 2), np.int64)
                    removed.append([{"start": a, "end": b} for a, b in pairs.tolist()])
                    edges = [0, *pairs.reshape(-1).tolist(), len(text)]
                    kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(piece.offsets)), pa.array(removed, type=spans_type), pa.array(kept, type=pa.binary())],
                    names=[id_col, "n_bytes", "removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, removed array<struct<start: long, end: long>>, kept binary")


def repeats_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    size = F.aggregate("removed", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return found.select(
        id_col, "n_bytes", size.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))
