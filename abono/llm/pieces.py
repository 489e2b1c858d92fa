"""SentencePiece encoding and decoding with batched numpy Viterbi.

A text is cut into units: runs of spaces with the word that follows. No piece crosses units, so
each different unit of a batch is encoded once, and units of equal length advance together,
character by character. Substring hashes probe the sorted hashes of all pieces; of the pieces
that may end at a character the best is kept as a back-pointer.

The model at hand is made of merges. Its encoding of a text is the one sequence of pieces in
which each neighbouring pair is itself what merging its characters gives. So a step's score
is 1 if the piece and the one that ends before it are such a pair, else it is ruled out; the
maximum over all steps is that sequence. Pairs are tried by merging once and remembered.

Characters without a piece become their UTF-8 bytes' pieces. Decoding returns the text, but
for U+2581, which the model itself reads as a space."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from abono.llm.text import Piece, list_array, mixed, per_document, ranges, running_hash, span_hash

SPACE = 0x2581
#: Longer units, and those that begin with several spaces, are merged one by one.
LONGEST = 64
CACHE_LOG2 = 21
TEXT_PIECE = 1 << 22


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: np.ndarray
    #: Id of the piece of byte 0; ids of bytes follow each other.
    byte0: int
    unknown: int
    controls: list[int]


def load(path: str) -> Vocabulary:
    """Pieces of a merge model with byte fallback, identity normalisation and a space put
    before each text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = len(model)
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if len(byte_ids) != 256 or byte_ids != list(range(byte_ids[0], byte_ids[0] + 256)):
        raise ValueError(f"{path}: a model with the 256 byte pieces in a row is needed")
    controls = [i for i in range(n) if model.is_control(i)]
    return Vocabulary([model.id_to_piece(i) for i in range(n)], np.array([model.get_score(i) for i in range(n)]), byte_ids[0], model.unk_id(), controls)


_encoders: dict[int, Encoder] = {}


def encoder_of(v: Vocabulary) -> Encoder:
    """The same encoder, with what it has remembered, for all tasks of a worker."""
    name = hash((tuple(v.pieces), v.scores.tobytes()))
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(v)
    return _encoders[name]


class Encoder:
    def __init__(self, v: Vocabulary) -> None:
        self.v = v
        special = {v.unknown, *v.controls, *range(v.byte0, v.byte0 + 256)}
        self.ids = {p: i for i, p in enumerate(v.pieces) if i not in special}
        self.unknown_piece = len(v.pieces)
        whole = [(p, i) for p, i in self.ids.items() if self.merged(p) == [i]]
        if any(c not in self.ids for p, _ in whole for c in p):
            raise ValueError("a piece has a character that is no piece")
        flat = np.concatenate([np.array([ord(c) for c in p], dtype=np.uint32) for p, _ in whole])
        cuts = np.concatenate([[0], np.cumsum([len(p) for p, _ in whole])])
        keys = span_hash(running_hash(flat), cuts[:-1], cuts[1:])
        order = np.argsort(keys)
        self.keys, self.found = keys[order], np.array([i for _, i in whole])[order]
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.longest = int(np.diff(cuts).max())
        self.pair_keys = np.full(1 << CACHE_LOG2, -1, dtype=np.int64)
        self.pair_fits = np.zeros(1 << CACHE_LOG2, dtype=bool)
        names = [p.replace(chr(SPACE), " ").encode() for p in v.pieces]
        for i in v.controls:
            names[i] = b""
        for b in range(256):
            names[v.byte0 + b] = bytes([b])
        names[v.unknown] = " ⁇ ".encode()
        self.bytes_flat = np.frombuffer(b"".join(names), dtype=np.uint8)
        self.bytes_cuts = np.concatenate([[0], np.cumsum([len(x) for x in names])])

    def merged(self, text: str) -> list[int]:
        """Ids by merging the best neighbouring pair again and again, the left of equal ones;
        for an unknown character its bytes' ids."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts):
                both = parts[i] + parts[j]
                if both in self.ids:
                    heapq.heappush(heap, (-self.v.scores[self.ids[both]], i, both))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, both = heapq.heappop(heap)
            if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != both:
                continue
            j = after[i]
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out = []
        for part in parts:
            if part is None:
                continue
            if part in self.ids:
                out.append(self.ids[part])
            else:
                out.extend(self.v.byte0 + b for b in part.encode())
        return out

    def _probe(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 if none."""
        out = np.full(len(h), -1, dtype=np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[place] == h[at]
        out[at[same]] = self.found[place[same]]
        return out

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the two pieces' characters gives these two pieces."""
        key = left * (self.unknown_piece + 1) + right
        slot = (mixed(key.astype(np.uint64)) >> np.uint64(64 - CACHE_LOG2)).astype(np.int64)
        missing = np.flatnonzero(self.pair_keys[slot] != key)
        if len(missing):
            out = np.zeros(len(key), dtype=bool)
            known = self.pair_keys[slot] == key
            out[known] = self.pair_fits[slot[known]]
            one, back = np.unique(key[missing], return_inverse=True)
            fits = np.array([self._pair(*divmod(k, self.unknown_piece + 1)) for k in one.tolist()])
            out[missing] = fits[back]
            slots = (mixed(one.astype(np.uint64)) >> np.uint64(64 - CACHE_LOG2)).astype(np.int64)
            self.pair_keys[slots], self.pair_fits[slots] = one, fits
            # of two pairs for one slot the last one's key and answer stay, together
            return out
        return self.pair_fits[slot]

    def _pair(self, left: int, right: int) -> bool:
        if self.unknown_piece in (left, right):
            return True
        return self.merged(self.v.pieces[left] + self.v.pieces[right]) == [left, right]

    def units(self, chars: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each unit, flat, and cuts."""
        lists: list[np.ndarray] = [np.zeros(0, np.int32)] * len(start)
        size = end - start
        several = (size > 1) & (chars[start] == SPACE) & (chars[np.minimum(start + 1, len(chars) - 1)] == SPACE)
        alone = several | (size > LONGEST)
        for k in np.flatnonzero(alone).tolist():
            lists[k] = np.array(self.merged("".join(map(chr, chars[start[k]:end[k]].tolist()))), dtype=np.int32)
        running = running_hash(chars)
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        flats = []
        for length in np.unique(size[~alone]).tolist():
            rows = np.flatnonzero((size == length) & ~alone)
            ids, n = self._advance(chars, running, start[rows], length)
            counts[rows] = n
            flats.append((rows, ids))
        cuts = np.concatenate([[0], np.cumsum(counts)])
        flat = np.zeros(int(cuts[-1]), dtype=np.int32)
        for k in np.flatnonzero(alone).tolist():
            flat[cuts[k]:cuts[k + 1]] = lists[k]
        for rows, ids in flats:
            flat[ranges(cuts[rows], counts[rows])] = ids
        return flat, cuts

    def _advance(self, chars: np.ndarray, running: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(start)
        last = np.full((length + 1, n), -1, dtype=np.int64)  # the piece that ends at a character
        back = np.zeros((length + 1, n), dtype=np.int8)
        for e in range(1, length + 1):
            best = np.zeros(n, dtype=bool)
            for size in range(min(self.longest, e), 0, -1):
                piece = self._probe(span_hash(running, start + e - size, start + e))
                if size == 1:
                    piece[piece < 0] = self.unknown_piece
                at = np.flatnonzero((piece >= 0) & ~best)
                if e > size and len(at):
                    before = last[e - size, at]
                    at = at[before >= 0]
                    at = at[self._fits(last[e - size, at], piece[at])] if len(at) else at
                best[at] = True
                last[e, at], back[e, at] = piece[at], size
        steps, owners = [], []
        place = np.full(n, length)
        open_ = np.arange(n)
        while len(open_):
            steps.append(last[place[open_], open_])
            owners.append((open_, place[open_] - 1))
            place[open_] -= back[place[open_], open_]
            open_ = open_[place[open_] > 0]
        piece = np.concatenate(steps)
        owner = np.concatenate([o for o, _ in owners])
        end = np.concatenate([p for _, p in owners])
        order = np.lexsort((end, owner))
        piece, owner, end = piece[order], owner[order], end[order]
        unknown = np.flatnonzero(piece == self.unknown_piece)
        if not len(unknown):
            return piece.astype(np.int32), np.bincount(owner, minlength=n)
        many = np.ones(len(piece), dtype=np.int64)
        raw = [chr(c).encode() for c in chars[start[owner[unknown]] + end[unknown]].tolist()]
        many[unknown] = [len(x) for x in raw]
        flat = np.repeat(piece, many)
        flat[np.repeat(piece == self.unknown_piece, many)] = self.v.byte0 + np.frombuffer(b"".join(raw), dtype=np.uint8)
        return flat.astype(np.int32), np.bincount(owner, weights=many, minlength=n).astype(np.int64)

    def encode(self, piece: Piece) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and cuts between texts."""
        n = len(piece)
        points = np.concatenate([[0], np.cumsum((piece.data & 0xC0) != 0x80)])[piece.offsets]
        chars = np.frombuffer(piece.data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        full = np.flatnonzero(np.diff(points) > 0)
        chars = np.insert(chars, points[full], SPACE)
        chars[chars == 32] = SPACE
        points = points + np.concatenate([[0], np.cumsum(np.diff(points) > 0)])
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        new = np.zeros(len(chars), dtype=bool)
        new[1:] = (chars[1:] == SPACE) & (chars[:-1] != SPACE)
        new[points[full]] = True
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(chars))
        h = span_hash(running_hash(chars), start, end)
        _, first, back = np.unique(h, return_index=True, return_inverse=True)
        flat, cuts = self.units(chars, start[first], end[first])
        count = np.diff(cuts)[back]
        ids = flat[ranges(cuts[:-1][back], count)]
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, ends[np.searchsorted(start, points)]

    def decode(self, ids: np.ndarray, cuts: np.ndarray) -> Piece:
        """Texts as bytes; the space put before each is taken off."""
        size = np.diff(self.bytes_cuts)[ids]
        data = self.bytes_flat[ranges(self.bytes_cuts[:-1][ids], size)]
        offsets = np.concatenate([[0], np.cumsum(size)])[cuts]
        full = offsets[:-1][np.diff(offsets) > 0]
        lead = full[data[full] == 32]
        gone = np.zeros(len(data) + 1, dtype=np.int64)
        gone[lead + 1] = 1
        kept = np.ones(len(data), dtype=bool)
        kept[lead] = False
        return Piece(data[kept], offsets - np.cumsum(gone)[offsets])


def encode(
    docs: DataFrame,
    *,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """One row per row of docs: id_col (or the columns keep), n_tokens, ids and round_trip
    (whether decoding gives the text again; not so for texts with U+2581).

    `model` is the path of a model file on the driver; its pieces are sent along. Null and
    empty texts have no ids. Repeated rows get a row each."""
    vocabulary = load(model)

    def make():
        encoder = encoder_of(vocabulary)

        def run(piece: Piece) -> dict[str, object]:
            ids, cuts = encoder.encode(piece)
            again = encoder.decode(ids, cuts)
            same = np.diff(again.offsets) == np.diff(piece.offsets)
            if not (same.all() and np.array_equal(again.data, piece.data)):
                for i in np.flatnonzero(same).tolist():
                    same[i] = again.text(i) == piece.text(i)
            return {"n_tokens": np.diff(cuts), "ids": list_array(ids, cuts, pa.int32()), "round_trip": same}
        return run

    return per_document(docs, text_col, make, "n_tokens long, ids array<int>, round_trip boolean", keep or [id_col], TEXT_PIECE)


def decode(tokens: DataFrame, *, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of tokens: id_col and text. Null arrays and empty ones give an empty
    text; bytes that are no UTF-8 become U+FFFD."""
    vocabulary = load(model)

    def run(batches):
        encoder = encoder_of(vocabulary)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            texts = encoder.decode(ids, cuts)
            made = [texts.text(i).decode(errors="replace") for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, type=pa.string())], names=[id_col, "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
