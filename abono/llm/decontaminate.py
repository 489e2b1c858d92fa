"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive words of a benchmark item. A table keeps for each block
of two words how far the search may move on without missing a pattern; where it may not move,
the block's hash selects the patterns that end with it, and their words are compared.

The search moves in many lanes at once: each lane covers some window ends of one document, so
long and short documents cost the same per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abono.llm.store import stored
from abono.llm.text import Piece, list_array, mixed, per_document, piece_of, ranges, sums_by, word_hashes, words_of

LANE = 64
_BLOCK = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Patterns:
    """Patterns of one length: words by row, the items of each, and the search tables."""

    length: int
    words: np.ndarray
    items: list[list[str]]
    mask: np.uint64 = field(init=False)
    shift: np.ndarray = field(init=False)
    suffix: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        m = self.length
        size = 1 << max(12, int(len(self.words) * m * 16).bit_length())
        self.mask = np.uint64(min(size, 1 << 22) - 1)
        wide = min(2, m)
        self.shift = np.full(int(self.mask) + 1, min(m - wide + 1, 255), dtype=np.uint8)
        for end in range(wide - 1, m):
            slots = (_blocks(self.words, end, wide) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, slots, np.uint8(min(m - 1 - end, 255)))
        tails = _blocks(self.words, m - 1, wide)
        self.order = np.argsort(tails, kind="stable")
        self.suffix = tails[self.order]


def _blocks(words: np.ndarray, end: int, wide: int) -> np.ndarray:
    last = words[:, end]
    return mixed(last.copy()) if wide == 1 else mixed(words[:, end - 1] * _BLOCK + last)


def windows(texts: list[tuple[str, str | None]], size: int) -> Iterator[tuple[tuple[int, ...], str]]:
    """(word hashes, item) of every window; a text of fewer words, but not none, is one."""
    for item, text in texts:
        piece = piece_of([text])
        h = word_hashes(piece, words_of(piece)).tolist()
        for i in range(max(1, len(h) - size + 1) if h else 0):
            yield tuple(h[i:i + size]), item


def pattern_blocks(benchmark: DataFrame, id_col: str, text_col: str, size: int, most: int) -> Iterator[list[Patterns]]:
    """Search tables of up to `most` windows each, however many items there are."""
    rows = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    found: dict[tuple[int, ...], set[str]] = {}
    for row in rows.toLocalIterator():
        for window, item in windows([(row[0], row[1])], size):
            if window not in found and len(found) == most:
                yield _tables(found)
                found = {}
            found.setdefault(window, set()).add(item)
    yield _tables(found)


def _tables(found: dict[tuple[int, ...], set[str]]) -> list[Patterns]:
    by: dict[int, list[tuple[int, ...]]] = {}
    for window in found:
        by.setdefault(len(window), []).append(window)
    return [Patterns(m, np.array(ws, dtype=np.uint64), [sorted(found[w]) for w in ws]) for m, ws in sorted(by.items())]


def occurrences(h: np.ndarray, cuts: np.ndarray, p: Patterns) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, pattern) of every occurrence in the texts' words."""
    m, wide = p.length, min(2, p.length)
    count = np.maximum(np.diff(cuts) - m + 1, 0)
    lanes = -(-count // LANE)
    step = ranges(np.zeros(len(count), np.int64), lanes)
    pos = np.repeat(cuts[:-1] + m - 1, lanes) + step * LANE
    stop = np.minimum(pos + LANE, np.repeat(cuts[1:], lanes))
    at, which = [], []
    while len(pos):
        block = mixed(h[pos]) if wide == 1 else mixed(h[pos - 1] * _BLOCK + h[pos])
        move = p.shift[(block & p.mask).astype(np.int64)].astype(np.int64)
        tested = np.flatnonzero(move == 0)
        if len(tested):
            low = np.searchsorted(p.suffix, block[tested])
            many = np.searchsorted(p.suffix, block[tested], side="right") - low
            first = np.repeat(pos[tested] - m + 1, many)
            pattern = p.order[ranges(low, many)]
            for j in range(m):
                same = h[first + j] == p.words[pattern, j]
                first, pattern = first[same], pattern[same]
            at.append(first)
            which.append(pattern)
            move[tested] = 1
        pos = pos + move
        go = pos < stop
        pos, stop = pos[go], stop[go]
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *at]), np.concatenate([none, *which])


def _searcher(tables: list[Patterns]):
    def make():
        def search(piece: Piece) -> dict[str, object]:
            words = words_of(piece)
            h = word_hashes(piece, words)
            change = np.zeros(len(h) + 1, dtype=np.int64)
            found: dict[int, set[str]] = {}
            for p in tables:
                at, which = occurrences(h, words.cuts, p)
                np.add.at(change, at, 1)
                np.add.at(change, at + p.length, -1)
                where = np.searchsorted(words.cuts, at, side="right") - 1
                for text, pattern in np.unique(np.stack([where, which]), axis=1).T.tolist():
                    found.setdefault(text, set()).update(p.items[pattern])
            hit = np.cumsum(change)[:-1] > 0
            return {
                "n_words": np.diff(words.cuts),
                "__hit": list_array(np.flatnonzero(hit) - words.cuts[words.text_of()[hit]], np.concatenate([[0], np.cumsum(sums_by(hit, words.cuts))]), pa.int64()),
                "__items": [sorted(found.get(i, ())) for i in range(len(piece))],
            }
        return search
    return make


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_windows: int = 200_000,
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of docs: id_col (or the columns `keep`), n_words, hit_words (array of
    the places of words inside any occurrence, from 0) and item_ids (sorted as strings, of
    the items with an occurring window).

    Null and empty texts have no words and no hits. Items with a null id or without words are
    no items; items with one id count as one. Repeated rows get a row each. A benchmark of
    more than `block_windows` windows is searched in several passes; what is sent to the
    executors never exceeds one block."""
    kept = [id_col] if keep is None else list(keep)
    blocks = pattern_blocks(benchmark, item_col, item_text_col, window, block_windows)
    fields = "n_words long, __hit array<long>, __items array<string>"
    out: DataFrame | None = None
    for tables in blocks:
        if out is None:
            source = docs.select(*dict.fromkeys([*kept, text_col]))
            out = per_document(source, text_col, _searcher(tables), fields, list(dict.fromkeys([*kept, text_col])))
            out = out.withColumnsRenamed({"__hit": "hit_words", "__items": "item_ids"})
        else:
            columns = list(dict.fromkeys([*kept, text_col, "hit_words", "item_ids"]))
            out = per_document(stored(out, "found"), text_col, _searcher(tables), fields, columns)
            out = out.withColumns({
                "hit_words": F.array_sort(F.array_union("hit_words", "__hit")),
                "item_ids": F.array_sort(F.array_union("item_ids", "__items")),
            }).drop("__hit", "__items")
    return out.select(*kept, "n_words", "hit_words", "item_ids")


def leaks_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))
