"""Spelling variants: words that differ by one character, found by a bidirectional FM-index.

A word of which another is one insertion, deletion or replacement away shares one of its halves
with it exactly: an edit lies in the first half or in the second. So words are dealt out by
pieces of their ends, and in each part a search has two schemes: match one half exactly, from the
middle of the word outwards, then turn and extend across the other half, allowing one error.

The index of a part is over its words, each between delimiters. It holds the sorted suffixes of
that text and of the text read backwards, as wavelet matrices. A state of the search is the
interval of suffixes that begin with what is matched so far, in both: extending it by a
character on one side narrows that side's interval by ranks, and moves the other's by the number
of smaller characters. A word matched from delimiter to delimiter is an interval of one row.

All queries of a part advance together, one character at a time, as numpy arrays."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abono.llm.store import stored
from abono.llm.text import _quoted, ranges

#: Runs of letters; A to Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"


@dataclass(frozen=True)
class Params:
    #: A word has so many characters and occurrences at least.
    least_length: int = 7
    least_count: int = 2
    #: A form occurs so many times as often as the word.
    factor: int = 10
    #: One character of a run is deleted where the run's checksum is divisible by this; 0: never.
    #: It makes variants to be found, as in a test of recall.
    noise: int = 0
    #: Words that one index holds, about. Larger blocks of words with equal ends are cut.
    part: int = 20_000
    #: Different runs that a task counts before it hands them on.
    held: int = 200_000


# Words and their counts.

def word_counts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", params: Params = Params()) -> DataFrame:
    """(word, n) of all words with their occurrences. Tasks count first, so a word that is
    everywhere reaches the sum as a row per task."""
    run_of = re.compile(f"[{LETTERS}]{{{params.least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> Iterator[pa.RecordBatch]:
            words = list(total)
            for i in range(0, len(words), 50_000):
                part = words[i:i + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([total[w] for w in part], pa.int64())], names=["word", "n"])
            total.clear()

        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                found = Counter(run_of.findall((text.as_py() or "").encode().lower().decode()))
                if params.noise:
                    start = zlib.crc32(f"{doc.as_py()}:".encode() if doc.is_valid else b":")
                    for run, n in found.items():
                        h = zlib.crc32(run.encode(), start)
                        if h % params.noise == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                            if len(run) < params.least_length:
                                continue
                        total[run] += n
                else:
                    total.update(found)
                if len(total) > params.held:
                    yield from flushed()
        yield from flushed()

    texts = docs.select(F.col(_quoted(id_col)).cast("string").alias("id"), F.col(_quoted(text_col)).cast("string").alias("text"))
    partial = texts.mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= params.least_count)


# The index.

def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of all suffixes of a text, sorted; by doubling the compared length."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        if width < n:
            after[:n - width] = rank[width:] + 1
        key = rank * np.int64(n + 1) + after
        order = np.argsort(key, kind="stable")
        step = np.ones(n, np.int64)
        step[0] = 0
        step[1:] = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step)
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class Wavelet:
    """Ranks of symbols, and of smaller symbols, in prefixes of a sequence."""

    def __init__(self, symbols: np.ndarray, bits: int) -> None:
        now, every = symbols, np.arange(1 << bits)
        self.levels: list[tuple[int, np.ndarray]] = []
        #: Where a symbol's occurrences begin after the last level.
        self.start = np.zeros(len(every), np.int64)
        for level in range(bits - 1, -1, -1):
            one = (now >> level) & 1
            zeros = np.concatenate([[0], np.cumsum(1 - one)])
            self.levels.append((level, zeros))
            now = np.concatenate([now[one == 0], now[one == 1]])
            below = zeros[self.start]
            self.start = np.where((every >> level) & 1, zeros[-1] + self.start - below, below)

    def ranks(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query: occurrences of its symbol before low and before high, and of smaller
        symbols between them."""
        smaller = np.zeros(len(symbol), np.int64)
        for level, zeros in self.levels:
            one = ((symbol >> level) & 1).astype(bool)
            below_low, below_high, all_zeros = zeros[low], zeros[high], zeros[-1]
            smaller += np.where(one, below_high - below_low, 0)
            low = np.where(one, all_zeros + low - below_low, below_low)
            high = np.where(one, all_zeros + high - below_high, below_high)
        start = self.start[symbol]
        return low - start, high - start, smaller


@dataclass
class States:
    """Intervals of suffix ranks, in the text (low) and in the text read backwards (back), all of
    the same size; and the query that each belongs to."""

    query: np.ndarray
    low: np.ndarray
    back: np.ndarray
    size: np.ndarray

    def of(self, which: np.ndarray) -> States:
        return States(self.query[which], self.low[which], self.back[which], self.size[which])

    def and_(self, other: States) -> States:
        return States(*[np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("query", "low", "back", "size")])


class Index:
    """A bidirectional FM-index of words. Symbol 0 is the delimiter; others are those of the
    alphabet, in order."""

    def __init__(self, words: Sequence[str]) -> None:
        points = [np.frombuffer(w.encode("utf-32-le"), dtype=np.uint32) for w in words]
        sizes = np.array([len(p) for p in points], dtype=np.int64)
        flat = np.concatenate(points)
        self.alphabet = np.unique(flat)
        text = np.zeros(int(sizes.sum()) + len(words) + 1, dtype=np.int64)
        first = 1 + np.cumsum(sizes + 1) - (sizes + 1)
        text[ranges(first, sizes)] = np.searchsorted(self.alphabet, flat) + 1
        self.n, self.sigma = len(text), len(self.alphabet) + 1
        bits = max(1, int(self.sigma - 1).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))])
        order = suffix_order(text)
        # Symbols in front of the sorted suffixes; the text's first one follows its last.
        self.before_row = text[order - 1]
        self.fore = Wavelet(self.before_row, bits)
        reverse = text[::-1]
        behind = suffix_order(reverse)
        self.after_row = reverse[behind - 1]
        self.hind = Wavelet(self.after_row, bits)
        # Row of the suffix that begins with a word's delimiter, to the word.
        self.word_at = np.full(self.n, -1, np.int64)
        row = np.empty(self.n, np.int64)
        row[order] = np.arange(self.n)
        self.word_at[row[first - 1]] = np.arange(len(words))

    def symbols(self, points: np.ndarray) -> np.ndarray:
        """Symbols of code points; -1 for those that no word has."""
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at + 1, -1)

    def start(self, queries: int) -> States:
        zero = np.zeros(queries, np.int64)
        return States(np.arange(queries), zero, zero.copy(), np.full(queries, self.n))

    def extend(self, states: States, symbol: np.ndarray, left: bool) -> States:
        """The states, each with its symbol put on the left or right; empty ones fall out."""
        known = symbol >= 0
        if not known.all():
            states, symbol = states.of(known), symbol[known]
        own, other = (states.low, states.back) if left else (states.back, states.low)
        ranks = self.fore if left else self.hind
        low, high, smaller = ranks.ranks(symbol, own, own + states.size)
        own, other, size = self.before[symbol] + low, other + smaller, high - low
        out = States(states.query, own, other, size) if left else States(states.query, other, own, size)
        return out.of(size > 0)

    def children(self, states: States, left: bool) -> tuple[States, np.ndarray]:
        """Every extension by a letter that occurs there, with that letter's symbol. The symbols of
        an interval of fewer rows than letters are read off its rows, else all letters are tried."""
        own, beside = (states.low, self.before_row) if left else (states.back, self.after_row)
        few = states.size < self.sigma
        small, large = np.flatnonzero(few), np.flatnonzero(~few)
        rows = ranges(own[small], states.size[small])
        seen = np.unique(np.repeat(small, states.size[small]) * self.sigma + beside[rows])
        seen = seen[seen % self.sigma > 0]
        tried = (large[:, None] * self.sigma + np.arange(1, self.sigma)[None, :]).ravel()
        parent, symbol = np.divmod(np.concatenate([seen, tried]), self.sigma)
        named = states.of(parent)
        place = np.arange(len(parent))
        found = self.extend(States(place, named.low, named.back, named.size), symbol, left)
        kept = found.query
        return States(named.query[kept], found.low, found.back, found.size), symbol[kept]


def one_error(index: Index, queries: np.ndarray, exact_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word) for words that differ from a query by one edit in one half, the other being
    equal. queries: symbols, a row per query, all of equal length. The exact half is matched from
    the middle outwards; the search then turns and goes across the other one.

    States without an error so far stay one per query. At each step they have children: the
    query's next letter (no error), any letter in its place, any letter before it, or none."""
    length = queries.shape[1]
    half = length // 2
    # Symbols in the order of the search; a delimiter ends each half.
    if exact_first:
        inner, outer, left = queries[:, :half][:, ::-1], queries[:, half:], True
    else:
        inner, outer, left = queries[:, half:], queries[:, :half][:, ::-1], False
    delimiter = np.zeros((len(queries), 1), np.int64)
    inner, outer = np.hstack([inner, delimiter]), np.hstack([outer, delimiter])
    exact = index.start(len(queries))
    for k in range(inner.shape[1]):
        exact = index.extend(exact, inner[exact.query, k], left)
    left = not left

    # With one error: by the number of the query's symbols consumed.
    none = exact.of(np.zeros(0, np.int64))
    erred = none
    steps = outer.shape[1]
    for k in range(steps):
        last = k == steps - 1
        arrived = index.extend(erred, outer[erred.query, k], left)
        if len(exact.query):
            children, letter = index.children(exact, left)
            wanted = outer[children.query, k]
            # One letter more, then the query's symbol.
            inserted = index.extend(children, wanted, left)
            arrived = arrived.and_(inserted)
            if not last:
                # Another letter in the symbol's place.
                arrived = arrived.and_(children.of(letter != wanted))
                # The symbol left out: what has been matched stands for one symbol more.
                arrived = arrived.and_(exact)
            exact = index.extend(exact, outer[exact.query, k], left)
        erred = arrived
    # An interval of a whole word is the row that begins with its first delimiter.
    word = index.word_at[erred.low]
    found = np.unique(np.stack([erred.query[word >= 0], word[word >= 0]], axis=1), axis=0)
    return found[:, 0], found[:, 1]


def near_pairs(words: Sequence[str], queries: Sequence[str], exact_first: bool) -> tuple[np.ndarray, np.ndarray]:
    """(query, word): places of all words that are one edit from a query and share its first half,
    or else not the first but the second. Both searches together find each pair once."""
    index = Index(words)
    length = np.array([len(q) for q in queries])
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for n in np.unique(length):
        places = np.flatnonzero(length == n)
        for i in range(0, len(places), 4_096):
            part = places[i:i + 4_096]
            points = np.frombuffer("".join(queries[j] for j in part).encode("utf-32-le"), dtype=np.uint32)
            q, w = one_error(index, index.symbols(points).reshape(len(part), n), exact_first)
            out.append((part[q], w))
    query, word = (np.concatenate(x) for x in zip(*out))
    half = [queries[q][:len(queries[q]) // 2] for q in query]
    same_first = np.array([words[w].startswith(h) for w, h in zip(word, half)], dtype=bool)
    kept = same_first if exact_first else ~same_first
    return query[kept], word[kept]


# Words dealt out by their ends.

def _end(word: Column, length: Column, first: bool, size: Column) -> Column:
    """The first or last `size` characters."""
    size = size.cast("int")
    return F.substr(word, F.lit(1) if first else (length - size + 1).cast("int"), size)


def _blocks(word: Column, length: Column, first: bool, of: Column) -> Column:
    """Block of words of length `of` that a word shares its half with: its first (of - 1) // 2 or
    its last of // 2 characters. Both are no longer than the half of a word that is shorter or
    longer by one, so both words of a pair name the same block."""
    size = F.floor((of - 1) / 2) if first else F.floor(of / 2)
    return F.struct(F.lit(first).alias("first"), of.cast("int").alias("of"), _end(word, length, first, size).alias("end"))


def near_words(words: DataFrame, params: Params = Params()) -> DataFrame:
    """(word, near, near_n): all pairs of words one edit apart, in both directions.

    Words with the same few first (or last) characters are one part's, so a word is searched for
    once per side. Where there are more of them than an index holds, they are dealt out by block
    instead, and a block of still more is cut into slots, all of which its queries go to."""
    word, length = F.col("word"), F.length("word")
    as_words = words.select("word", "n", F.explode(F.array(*[
        _blocks(word, length, first, length) for first in (True, False)])).alias("block"))
    as_queries = words.select("word", F.explode(F.array(*[
        _blocks(word, length, first, length + by) for first in (True, False) for by in (-1, 0, 1)])).alias("block"))
    sizes = as_words.groupBy("block").agg(F.count(F.lit(1)).alias("size"))
    short, end = F.lit((params.least_length - 1) // 2), F.col("block.end")
    short_end = F.when(F.col("block.first"), _end(end, F.length(end), True, short)).otherwise(_end(end, F.length(end), False, short))
    sizes = stored(sizes.select("block", "size", F.struct("block.first", short_end.alias("end")).alias("group")), "block-sizes")
    crowds = sizes.groupBy("group").agg(F.sum("size").alias("rows"))
    crowded = F.col("rows") > params.part
    slots = F.when(crowded, F.ceil(F.col("size") / params.part)).otherwise(1).cast("long")
    blocks = stored(sizes.join(crowds, "group").select("block", "size", "group", crowded.alias("crowded"), slots.alias("slots")), "blocks")
    total = blocks.agg(F.sum("size").alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(total / params.part))

    def part(slot: Column) -> Column:
        name = F.when(F.col("crowded"), F.xxhash64("block.of", "block.end", slot)).otherwise(F.xxhash64("group.end"))
        return F.struct("block.first", F.pmod(name, F.lit(parts)).cast("int").alias("part")).alias("part")

    indexed = as_words.join(blocks, "block").select(
        part(F.pmod(F.xxhash64("word"), F.col("slots"))), "word", "n", F.lit(True).alias("indexed"))
    # A word that is alone in a block has no partner there.
    asked = as_queries.join(blocks, "block").where((F.col("size") > 1) | (F.col("block.of") != F.length("word")))
    asked = asked.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)))
    asked = asked.select(part(F.col("slot")), "word", F.lit(None).cast("long").alias("n"), F.lit(False).alias("indexed"))

    def search(key: tuple, table: pa.Table) -> pa.Table:
        first = key[0].as_py()["first"]
        own = table.filter(table["indexed"])
        given = own["word"].to_pylist()
        queries = table.filter(pc.invert(table["indexed"]))["word"].unique().to_pylist()
        if not given or not queries:
            return pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.string()), "near_n": pa.array([], pa.int64())})
        q, w = near_pairs(given, queries, first)
        return pa.table({
            "word": pa.array(queries, pa.string()).take(pa.array(q)), "near": own["word"].combine_chunks().take(pa.array(w)),
            "near_n": own["n"].combine_chunks().take(pa.array(w))})

    rows = indexed.unionByName(asked)
    return rows.groupBy("part").applyInArrow(search, "word string, near string, near_n long")


def roots(forms: DataFrame, most: int, factor: int) -> DataFrame:
    """forms: (word, form), no word twice. (word, root): where following forms ends. A form is
    `factor` times as frequent, so chains have at most log(most) steps; each round doubles what
    a word has followed."""
    steps = max(1, math.ceil(math.log(max(most, 2)) / math.log(max(factor, 2))) + 1)
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return now


def variants(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", params: Params = Params()) -> DataFrame:
    """A row per word of the texts: word, form, root, n, n_near, form_n.

    Words are maximal runs of LETTERS, A to Z lower-cased, of params.least_length characters and
    params.least_count occurrences (n). Its near words differ by one inserted, deleted or replaced
    character; of these form is the one with the largest n (ties: least in code-point order), if
    that is params.factor times the word's. root: where following forms ends, the word itself
    without one.

    Null texts have no words. Null ids count as an empty one, repeated rows as often as they
    stand. Other columns of docs are not read. A very long run is a word like any other."""
    if params.factor < 2:
        raise ValueError("a form must be more frequent than the word: factor is 2 at least")
    words = stored(word_counts(docs, text_col, id_col, params), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")
    found = near_words(words, params).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    usual = -F.col("best.less") >= params.factor * F.col("n")
    judged = stored(words.join(found, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(usual, F.col("best.near")).alias("form"), F.when(usual, -F.col("best.less")).alias("form_n")), "forms")
    most = judged.agg(F.max("n").alias("n")).first()["n"] or 0
    ends = roots(judged.where("form IS NOT NULL"), most, params.factor)
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
