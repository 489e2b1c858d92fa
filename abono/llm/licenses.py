"""License scans: short notices found with a bounded number of edits.

A notice that occurs with at most k edits keeps at least one of its k + 1 parts unchanged. An
automaton of all parts finds those seeds in one pass; only around a seed does the regex
library look for the whole notice with up to k edits.

Texts are searched as lower-case words joined by single spaces, so line breaks, comment signs
and punctuation count as no edits."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abono.llm.text import LOWER, Piece, per_document, sums_by, words_of

#: Phrases that count exactly, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of common notices, and labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl-3.0",
    "under the terms of the gnu general public license": "gpl",
    "this program is free software you can redistribute it and or modify": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the bsd 3 clause license": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "creative commons attribution": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
}


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int

    @property
    def seeds(self) -> list[tuple[int, str]]:
        """(place in the notice, part) of its edits + 1 parts."""
        cuts = [len(self.text) * i // (self.edits + 1) for i in range(self.edits + 2)]
        return [(a, self.text[a:b]) for a, b in pairwise(cuts)]

    @cached_property
    def patterns(self) -> list[regex.Pattern]:
        """By the edits allowed."""
        return [regex.compile(f"(?:{regex.escape(self.text)}){{e<={e}}}") for e in range(self.edits + 1)]

    @cached_property
    def masks(self) -> dict[str, int]:
        """Bits of the places of each character."""
        return {c: sum(1 << i for i, x in enumerate(self.text) if x == c) for c in set(self.text)}

    def nearest(self, text: str) -> tuple[int, int]:
        """(edits, end) of the first substring with the fewest edits, by a column of the edit
        distances' differences per character, as bits of two integers. More edits than allowed
        are one more than that."""
        masks, size = self.masks, len(self.text)
        full, top = (1 << size) - 1, 1 << (size - 1)
        up, down, score = full, 0, size
        best, end = self.edits + 1, 0
        for i, c in enumerate(text):
            same = masks.get(c, 0)
            level = (((same & up) + up) ^ up) | same
            more, less = (down | ~(level | up)) & full, up & level
            if more & top:
                score += 1
            elif less & top:
                score -= 1
            more <<= 1
            up, down = ((less << 1) | ~(same | down | more)) & full, more & (same | down) & full
            if score < best:
                best, end = score, i + 1
        return best, end


def notices(table: dict[str, str], share: float) -> list[Notice]:
    """Edits allowed: `share` of a notice's characters, but parts of at least six."""
    return [Notice(text, label, min(int(len(text) * share), len(text) // 6 - 1)) for text, label in table.items()]


def plain(piece: Piece) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Lower-case words, each with a space before and after, texts ended by a line feed; the
    place in the piece of each byte; where each text begins."""
    words = words_of(piece)
    low = LOWER[piece.data]
    size = words.end - words.start
    # every word takes its bytes and a space; every text a space before them and a line feed
    extra = sums_by(size + 1, words.cuts)
    begin = np.zeros(len(piece) + 1, np.int64)
    np.cumsum(extra + 2, out=begin[1:])
    before = np.cumsum(size + 1) - (size + 1)
    out_at = before + 1 + 2 * words.text_of()
    out = np.full(int(begin[-1]), 32, dtype=np.uint8)
    place = np.zeros(len(out), dtype=np.int64)
    if len(size):
        shift = np.repeat(words.start - out_at, size)
        target = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size) + np.repeat(out_at, size)
        place[target] = target + shift
        out[target] = low[place[target]]
    out[begin[1:] - 1] = 10
    return out.tobytes(), place, begin


def phrase_places(flat: bytes, phrase: str) -> list[int]:
    """Places of the first byte of the phrase, where its words stand whole."""
    sought, places = f" {phrase} ".encode(), []
    at = flat.find(sought)
    while at >= 0:
        places.append(at + 1)
        at = flat.find(sought, at + 1)
    return places


#: A match: edits, less its length, start, end, notice, and the range it was sought in.
Match = tuple[int, int, int, int, int, int, int]


def best_match(flat: str, k: int, notice: Notice, begin: int, end: int) -> list[Match]:
    """The first match of the notice in flat[begin:end] with the fewest edits, if there is one.
    The pattern is asked for no more edits than that, as its time grows fast with them."""
    size = len(notice.text)
    if end - begin < size - notice.edits:
        return []
    edits, last = notice.nearest(flat[begin:end])
    if edits > notice.edits:
        return []
    m = notice.patterns[edits].search(flat, max(begin, begin + last - size - edits), begin + last)
    return [(edits, m.start() - m.end(), m.start(), m.end(), k, begin, end)]


def seed_ranges(flat: str, found: Sequence[Notice], automaton: ahocorasick.Automaton) -> set[tuple[int, int, int]]:
    """(notice, start, end): a notice that a seed belongs to lies in there as a whole, and no
    line feed does."""
    out = set()
    for last, hits in automaton.iter(flat):
        for k, offset, size in hits:
            seed = last - size + 1
            first = seed - offset
            notice = found[k]
            # a seed has no line feed, so its document ends on either side of it
            low = max(flat.rfind("\n", max(0, first - notice.edits), seed) + 1, first - notice.edits, 0)
            high = min(first + len(notice.text) + notice.edits, len(flat))
            feed = flat.find("\n", last, high)
            out.add((k, low, high if feed < 0 else feed))
    return out


def fuzzy_spans(flat: str, found: Sequence[Notice], automaton: ahocorasick.Automaton) -> list[tuple[int, int, int, int]]:
    """(start, end, notice, edits) of the notices in `flat`, none across a line feed. The match
    with the fewest edits, then the longer and the earlier, is taken first; every other one has to
    lie in what is then free, and is sought there again if it does not. A search never leaves the
    few characters around its seed, so the time grows with the number of seeds."""
    heap = [m for k, a, b in seed_ranges(flat, found, automaton) for m in best_match(flat, k, found[k], a, b)]
    heapify(heap)
    taken: list[tuple[int, int, int, int]] = []
    while heap:
        edits, _, start, end, k, a, b = heappop(heap)
        low = bisect_left(taken, (a,))
        low -= low > 0 and taken[low - 1][1] > a
        high = bisect_left(taken, (b,), low)
        used = [(x[0], x[1]) for x in taken[low:high]]
        if all(y <= start or end <= x for x, y in used):
            insort(taken, (start, end, k, edits))
            used = sorted([*used, (start, end)])
        for x, y in pairwise([(a, a), *used, (b, b)]):
            for m in best_match(flat, k, found[k], x[1], y[0]):
                heappush(heap, m)
    return taken


def scanner(table: dict[str, str], phrases: dict[str, str], share: float):
    def make():
        found = notices(table, share)
        parts: dict[str, list[tuple[int, int, int]]] = {}
        for k, notice in enumerate(found):
            for offset, part in notice.seeds:
                parts.setdefault(part, []).append((k, offset, len(part)))
        automaton = ahocorasick.Automaton()
        for part, hits in parts.items():
            automaton.add_word(part, hits)
        automaton.make_automaton()
        space = ord(" ")

        def scan(piece: Piece) -> dict[str, object]:
            flat, place, begin = plain(piece)
            words = words_of(piece)
            n = len(piece)
            base: list[list[dict]] = [[] for _ in range(n)]
            other: list[list[dict]] = [[] for _ in range(n)]
            text_at = lambda at: int(np.searchsorted(begin, at, side="right")) - 1
            letters = np.frombuffer(flat, dtype=np.uint8)
            spaces = np.flatnonzero(letters == space)
            points = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])
            for phrase, label in phrases.items():
                for at in phrase_places(flat, phrase):
                    i = text_at(at)
                    word = int(np.searchsorted(spaces, at) - np.searchsorted(spaces, begin[i] + 1))
                    base[i].append({"label": label, "first_word": word})
            for a, b, k, edits in fuzzy_spans(flat.decode("latin-1"), found, automaton):
                while a < b and letters[a] <= space:
                    a += 1
                while b > a and letters[b - 1] <= space:
                    b -= 1
                if a == b:
                    continue
                i = text_at(a)
                first, last = int(place[a]), int(place[b - 1]) + 1
                start = int(points[first] - points[piece.offsets[i]])
                size = int(points[last] - points[first])
                other[i].append({"label": found[k].label, "notice": found[k].text, "start": start, "end": start + size,
                                 "edits": edits, "score": 1 - edits / len(found[k].text)})
            return {"n_words": np.diff(words.cuts), "phrases": base, "notices": other}
        return scan
    return make


def scan_licenses(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    table: dict[str, str] = NOTICES,
    phrases: dict[str, str] = PHRASES,
    share: float = 0.1,
) -> DataFrame:
    """One row per row of docs: id_col, n_words, phrases (label and first word, from 0, of each
    exact phrase) and notices (label, notice, code points start and end in the text, edits and
    score of each notice found with at most `share` of its characters edited).

    Null and empty texts have neither. Repeated rows get a row each."""
    fields = ("n_words long, phrases array<struct<label: string, first_word: long>>, notices array<struct<"
              "label: string, notice: string, start: long, end: long, edits: int, score: double>>")
    return per_document(docs, text_col, scanner(table, phrases, share), fields, [id_col])


def licenses_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    places = F.transform("phrases", lambda x: x["first_word"])
    labels = F.transform("phrases", lambda x: x["label"])
    every = F.array_sort(F.array_distinct(F.concat(labels, F.transform("notices", lambda x: x["label"]))))
    best = F.array_max(F.transform("notices", lambda x: x["score"]))
    return found.select(
        id_col, "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))
