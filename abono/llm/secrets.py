"""Secret scans: exact patterns, and a linear-chain conditional random field beside them.

The patterns find assignments, access keys and long hexadecimal strings. The random field tags
tokens as begin, inside or outside of a secret from their shape, the characters and words next
to them and their file's share of digits. It learns from the patterns' own finds in a bounded
sample, so it knows what secrets look like and adds those the patterns miss. Tags are decoded
by Viterbi's algorithm; tokens that are outside in every best path split a text into short
stretches first, which changes no result."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abono.llm.text import LOWER, Piece, Words, per_document, ranges, running_hash, sliced, span_hash, sums_by, words_of

#: The patterns, and the least length of what they find.
ASSIGN = re.compile(rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: One of these, in lower case, is in every text with an assignment.
KEYWORDS = (b"passw", b"secret", b"token", b"api_key", b"apikey")

OUTSIDE, BEGIN, INSIDE = 0, 1, 2


def _bytes_of(chars: str) -> np.ndarray:
    marked = np.zeros(256, dtype=bool)
    marked[list(chars.encode())] = True
    return marked


DIGIT = _bytes_of("0123456789")
UPPER = _bytes_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _bytes_of("abcdefghijklmnopqrstuvwxyz")
HEX = _bytes_of("0123456789abcdef")
SIGN = _bytes_of("+/_.=-")
TOKEN = LETTER | DIGIT | SIGN
TOKEN[128:] = True
#: What stands before or after a token: nothing, white space, quote, : or =, other.
AROUND = np.full(256, 4, dtype=np.int64)
AROUND[[32, 9, 10, 11, 12, 13]] = 1
AROUND[[34, 39, 96]] = 2
AROUND[[58, 61]] = 3


@dataclass(frozen=True)
class Params:
    #: Hash slots of words.
    words_log2: int = 12
    #: Tokens of a training window.
    window: int = 24
    rounds: int = 30
    rate: float = 0.13
    ridge: float = 1e-3
    #: Documents of a round at least; a round takes all of a smaller table.
    batch: int = 2_000

    @property
    def sizes(self) -> tuple[int, ...]:
        words = 1 << self.words_log2
        return (32, 6, 6, 8, 8, 5, 5, 8, words, words, words)


#: Features that are looked up and counted together, as they have few joint values; then the words.
GROUPS = ((0, 1, 2, 3), (4, 5, 6, 7), (8,), (9,), (10,))


def joint(rows: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """One number for several features of each token, given by the last axis."""
    number = rows[..., 0]
    for k in range(1, len(sizes)):
        number = number * sizes[k] + rows[..., k]
    return number


def base_spans(piece: Piece) -> list[list[tuple[int, int, int, int]]]:
    """(start, kind, end, start of the secret itself) in bytes of each text, in order."""
    found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(piece))]
    runs = words_of(piece, HEX)
    for k in np.flatnonzero(runs.end - runs.start >= LEAST["hex"]).tolist():
        i = int(np.searchsorted(runs.cuts, k, side="right")) - 1
        a, b = int(runs.start[k] - piece.offsets[i]), int(runs.end[k] - piece.offsets[i])
        found[i].append((a, 2, b, a))
    for i in range(len(piece)):
        text = piece.text(i)
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            for m in ASSIGN.finditer(text):
                if len(m[2]) >= LEAST["assign"]:
                    found[i].append((m.start(), 0, m.end(), m.start(2)))
        if b"AKIA" in text:
            for m in ACCESS.finditer(text):
                if len(m[0]) >= LEAST["access"]:
                    found[i].append((m.start(), 1, m.end(), m.start()))
    return [sorted(f) for f in found]


#: Bits of a byte's share in each count of a token's bytes; longer tokens are counted one by one.
FIELD = 12
COUNTED = (DIGIT, UPPER, LETTER, HEX, SIGN)
PACKED = sum(marked.astype(np.uint64) << np.uint64(FIELD * i) for i, marked in enumerate(COUNTED))


def byte_counts(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Of each token, how many of its bytes are in each of COUNTED, all from one running sum: it
    may overflow, its differences don't."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(PACKED[data], out=total[1:])
    packed = total[end] - total[start]
    low = np.uint64((1 << FIELD) - 1)
    counts = [((packed >> np.uint64(FIELD * i)) & low).astype(np.int64) for i in range(len(COUNTED))]
    for k in np.flatnonzero(end - start >= 1 << FIELD).tolist():
        for count, marked in zip(counts, COUNTED):
            count[k] = np.count_nonzero(marked[data[start[k]:end[k]]])
    return counts


def token_features(piece: Piece, p: Params) -> tuple[Words, np.ndarray]:
    """Tokens, and a row of small numbers for each, as many as p.sizes; columns are contiguous."""
    tokens = words_of(piece, TOKEN)
    start, end, cuts, data = tokens.start, tokens.end, tokens.cuts, piece.data
    n = len(start)
    if not n:
        return tokens, np.zeros((0, len(p.sizes)), np.int32)
    size = end - start
    text = tokens.text_of()
    digits, uppers, letters, hexes, signs = byte_counts(data, start, end)
    kind = DIGIT[data].astype(np.int8) + 2 * LETTER[data]
    turns = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(kind[1:] != kind[:-1], out=turns[2:])
    changes = turns[end] - turns[start + 1]
    shape = np.select(
        [digits == size, hexes == size, letters + digits + signs < size, uppers == size, (uppers == 1) & UPPER[data[start]] & (letters == size),
         (letters == size) & (uppers == 0), letters + digits == size],
        [0, 1, 2, 3, 4, 5, 6], 7)
    before = np.where(start > piece.offsets[text], AROUND[data[np.maximum(start - 1, 0)]], 0)
    after = np.where(end < piece.offsets[text + 1], AROUND[data[np.minimum(end, len(data) - 1)]], 0)
    dense = sums_by(digits, cuts) * 200 // np.maximum(np.diff(piece.offsets), 1)  # all digits are in tokens
    word = (span_hash(running_hash(LOWER[data]), start, end) >> np.uint64(64 - p.words_log2)).astype(np.int64)

    def near(by: int) -> np.ndarray:
        at = np.arange(n) + by
        inside = (at >= cuts[text]) & (at < cuts[text + 1])
        return np.where(inside, word[np.clip(at, 0, n - 1)], 0)

    log_size = np.minimum(np.where(size < 20, size, 16 + np.log2(size).astype(np.int64)), 31)
    rows = np.empty((len(p.sizes), n), np.int32)
    for row, feature in zip(rows, (
            log_size, digits * 5 // size, uppers * 5 // size, np.minimum(changes, 7), shape, before, after,
            np.minimum(dense, 7)[text], near(-1), near(1), near(-2))):
        row[:] = feature
    return tokens, rows.T


def true_tags(piece: Piece, tokens: Words) -> np.ndarray:
    """Tags by the patterns' finds: tokens that touch the secret itself."""
    tags = np.zeros(len(tokens.start), dtype=np.int64)
    for i, spans in enumerate(base_spans(piece)):
        a, b = tokens.cuts[i], tokens.cuts[i + 1]
        for _, _, end, secret in spans:
            first = a + int(np.searchsorted(tokens.end[a:b], piece.offsets[i] + secret, side="right"))
            last = a + int(np.searchsorted(tokens.start[a:b], piece.offsets[i] + end))
            tags[first:last] = INSIDE
            tags[first:first + 1] = BEGIN
    return tags


#: Kinds of training windows: without and with a find.
PLAIN, FOUND = 0, 1
#: Parts of one in which a token's share of the gradient is counted, so that sums are exact.
GRAIN = 1 << 20


@dataclass
class Windows:
    """All tokens of the texts in runs of Params.window: features and tags, tag -1 beyond the
    text; the tags next to each run, outside at the text's ends; the kind."""

    rows: np.ndarray
    tags: np.ndarray
    left: np.ndarray
    right: np.ndarray
    kind: np.ndarray


def windows(piece: Piece, p: Params) -> Windows:
    tokens, rows = token_features(piece, p)
    tags = true_tags(piece, tokens)
    count = -(-np.diff(tokens.cuts) // p.window)
    begin, end = np.repeat(tokens.cuts[:-1], count), np.repeat(tokens.cuts[1:], count)
    first = begin + p.window * ranges(np.zeros(len(count), np.int64), count)
    last = np.minimum(first + p.window, end)
    at = first[:, None] + np.arange(p.window)
    real = at < last[:, None]
    at = np.where(real, at, 0)
    own = np.where(real, tags[at], -1)
    rows = np.moveaxis(np.stack([np.where(real, column[at], 0) for column in rows.T]), 0, -1)
    left = np.where(first > begin, tags[np.maximum(first - 1, 0)], OUTSIDE)
    right = np.where(last < end, tags[np.minimum(last, len(tags) - 1)], OUTSIDE)
    return Windows(rows, own, left, right, np.where((own > 0).any(axis=1), FOUND, PLAIN))


@dataclass
class Model:
    tables: list[np.ndarray]
    moves: np.ndarray
    p: Params

    def emissions(self, rows: np.ndarray) -> np.ndarray:
        """Scores of each tag; the last axis of rows holds the features."""
        total = np.zeros((*rows.shape[:-1], 3), dtype=np.float64)
        for own in GROUPS:
            table = self.tables[own[0]]
            for k in own[1:]:
                table = (table[:, None] + self.tables[k]).reshape(-1, 3)
            total += table.take(joint(rows[..., own[0]:own[-1] + 1], [self.p.sizes[k] for k in own]), axis=0)
        return total


#: A weight of a move from one tag to another stays within this, either way.
MOST = 1.0


def gradient(w: Windows, model: Model) -> np.ndarray:
    """Of each kind of windows: the sums of expected less true features, tables first, then
    moves, in GRAINs, and the number of windows."""
    p, n, t = model.p, *w.tags.shape
    out = np.zeros((2, 3 * sum(p.sizes) + 10), dtype=np.int64)
    real = w.tags >= 0
    length = real.sum(axis=1)
    score = model.emissions(w.rows)
    # probabilities up to a factor for each token, so that nothing over- or underflows; each is
    # rounded to GRAINs below, so single precision is enough
    score = np.exp(np.maximum(score - score.max(axis=2, keepdims=True), -30)).astype(np.float32)
    step = np.exp(model.moves).astype(np.float32)
    forward, backward = np.zeros((n, t, 3), np.float32), np.zeros((n, t, 3), np.float32)
    for j in range(t):
        now = score[:, j] * (forward[:, j - 1] @ step if j else step[w.left])
        forward[:, j] = now / now.sum(axis=1, keepdims=True)
    for j in range(t - 1, -1, -1):
        now = (score[:, j + 1] * backward[:, j + 1]) @ step.T if j + 1 < t else np.ones((n, 3), np.float32)
        now = np.where((length == j + 1)[:, None], step[:, w.right].T, now)
        backward[:, j] = now / now.sum(axis=1, keepdims=True)
    true = w.tags[..., None] == np.arange(3)
    prob = forward * backward
    prob *= (real / prob.sum(axis=2))[..., None]
    apart = np.ascontiguousarray(np.rint((prob - true) * GRAIN)[real].T, dtype=np.float64)
    kind, at = np.broadcast_to(w.kind[:, None], (n, t))[real], 0
    for own in GROUPS:
        sizes = [p.sizes[k] for k in own]
        many = int(np.prod(sizes))
        slot = kind * many + joint(w.rows[..., own[0]:own[-1] + 1], sizes)[real]
        got = np.stack([np.bincount(slot, weights=x, minlength=2 * many) for x in apart], axis=1).reshape(2, *sizes, 3)
        for i, size in enumerate(sizes, 1):
            others = tuple(j for j in range(1, len(sizes) + 1) if j != i)
            out[:, at:at + 3 * size] = got.sum(axis=others).reshape(2, -1)
            at += 3 * size
    pair = forward[:, :-1, :, None] * step * (score[:, 1:] * backward[:, 1:])[:, :, None]
    pair /= pair.sum(axis=(2, 3), keepdims=True)
    pair -= true[:, :-1, :, None] & true[:, 1:, None, :]
    moves = np.rint(pair * real[:, 1:, None, None] * GRAIN).sum(axis=1)
    each, far = np.arange(n), length - 1
    moves[each, w.left] += np.rint((prob[:, 0] - true[:, 0]) * GRAIN)
    moves[each, :, w.right] += np.rint((prob[each, far] - true[each, far]) * GRAIN)
    for kind in (PLAIN, FOUND):
        out[kind, at:at + 9] = moves[w.kind == kind].sum(axis=0).reshape(-1)
        out[kind, -1] = (w.kind == kind).sum()
    return out


def _summed(docs: DataFrame, model: Model, step: int) -> np.ndarray:
    """The gradient of all windows of the texts docs.t, summed in each task, then over tasks.
    Which windows do without words goes by their first token's features, and by the step."""
    wide = 3 * sum(model.p.sizes) + 10
    padded = wide + -wide % 3  # three numbers, those of one feature's value, are a row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, padded), dtype=np.int64)
        for batch in batches:
            for _, piece in sliced(batch, 0):
                w = windows(piece, model.p)
                if len(w.kind):
                    # every other window without its words, so that shape alone counts as well
                    bare = (w.rows[:, 0].sum(axis=1) + w.tags[:, 0] + step) % 2 == 0
                    w.rows[bare, :, len(model.p.sizes) - 3:] = 0
                    total[:, :wide] += gradient(w, model)
        flat = total.reshape(-1, 3)
        at = np.flatnonzero(flat.any(axis=1))
        yield pa.RecordBatch.from_pydict({"slot": at.astype(np.int64), "x": flat[at, 0], "y": flat[at, 1], "z": flat[at, 2]})

    found = docs.mapInArrow(run, "slot long, x long, y long, z long").groupBy("slot").agg(*[F.sum(c).alias(c) for c in "xyz"]).toArrow()
    out = np.zeros((2 * padded // 3, 3), dtype=np.int64)
    for y, c in enumerate("xyz"):
        out[found["slot"].to_numpy(), y] = found[c].to_numpy()
    return out.reshape(2, padded)[:, :wide]


def train(docs: DataFrame, id_col: str, text_col: str, p: Params) -> Model:
    """Penalised likelihood by Adam steps, windows with finds weighing as much as all
    others, so rare finds count. Each round takes the next of as many parts as rounds at most, so
    all documents are learned from."""
    model = Model([np.zeros((size, 3)) for size in p.sizes], np.zeros((3, 3)), p)
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t")).where("t != ''")
    parts = max(1, min(p.rounds, texts.count() // p.batch))
    texts = texts.withColumn("part", F.pmod(F.xxhash64("id", F.octet_length("t")), F.lit(parts)))
    slots = [*model.tables, model.moves]
    first, second = [np.zeros_like(x) for x in slots], [np.zeros_like(x) for x in slots]
    n_found = 0
    for step in range(1, p.rounds + 1):
        sums = _summed(texts.where(F.col("part") == (step - 1) % parts).select("t"), model, step)
        n_found += int(sums[FOUND, -1])
        if step == parts and not n_found:
            break
        slope_of = (sums[:, :-1] / np.maximum(sums[:, -1:], 1)).sum(axis=0) / (2 * GRAIN)
        at = 0
        for k, value in enumerate(slots):
            slope = slope_of[at:at + value.size].reshape(value.shape) + p.ridge * value
            at += value.size
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope**2
            value -= p.rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        np.clip(model.moves, -MOST, MOST, out=model.moves)
    if not n_found:
        model = Model([np.zeros((size, 3)) for size in p.sizes], np.zeros((3, 3)), p)
        model.tables[0][:, OUTSIDE] = 2 * MOST * 3
    return model


def decode(scores: np.ndarray, cuts: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of every text. A token whose outside score leads by more than two moves
    can differ is outside in the best path, so only stretches between such tokens are open."""
    tags = np.zeros(len(scores), dtype=np.int8)
    room = 2 * (moves.max() - moves.min())
    opened = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= room
    first, last = opened.copy(), opened.copy()
    first[1:] &= ~opened[:-1]
    last[:-1] &= ~opened[1:]
    edges = cuts[1:-1]
    edges = edges[(edges > 0) & (edges < len(opened))]
    first[edges], last[edges - 1] = opened[edges], opened[edges - 1]
    start, size = np.flatnonzero(first), np.flatnonzero(last) + 1 - np.flatnonzero(first)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    if not len(start):
        return tags
    best = scores[start] + moves[OUTSIDE]
    back = []
    for j in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -j))
        paths = best[:n, :, None] + moves
        back.append(paths.argmax(axis=1).astype(np.int8))
        best[:n] = scores[start[:n] + j] + paths.max(axis=1)
    tag = (best + moves[:, OUTSIDE]).argmax(axis=1).astype(np.int8)
    for j in range(int(size[0]) - 1, -1, -1):
        n = int(np.searchsorted(-size, -j))
        tags[start[:n] + j] = tag[:n]
        if j:
            tag[:n] = back[j - 1][np.arange(n), tag[:n]]
    return tags


def _spans(piece: Piece, model: Model) -> list[list[tuple[int, int, int]]]:
    """(start, kind, end) in code points. Of the field's spans what lies outside the patterns',
    so that the rest of a token is kept of which a pattern found only a part."""
    base = base_spans(piece)
    tokens, rows = token_features(piece, model.p)
    tags = decode(model.emissions(rows), tokens.cuts, model.moves)
    every: list[list[tuple[int, int, int]]] = [[(a, k, b) for a, k, b, _ in spans] for spans in base]
    # a span goes from a token that begins one, or is inside after an outside one, to its last
    head = np.flatnonzero((tags == BEGIN) | ((tags == INSIDE) & (np.concatenate([[0], tags[:-1]]) == OUTSIDE)))
    for k in head.tolist():
        i = int(np.searchsorted(tokens.cuts, k, side="right")) - 1
        last = k
        while last + 1 < tokens.cuts[i + 1] and tags[last + 1] == INSIDE:
            last += 1
        a, b = int(tokens.start[k] - piece.offsets[i]), int(tokens.end[last] - piece.offsets[i])
        for x, _, y, _ in base[i]:
            if x < b and a < y:
                if a < x and TOKEN[piece.data[piece.offsets[i] + a:piece.offsets[i] + x]].any():
                    every[i].append((a, 3, x))
                a = max(a, y)
        if a < b and TOKEN[piece.data[piece.offsets[i] + a:piece.offsets[i] + b]].any():
            every[i].append((a, 3, b))
    for i, spans in enumerate(every):
        if spans:
            at = np.cumsum((piece.data[piece.offsets[i]:piece.offsets[i + 1]] & 0xC0) != 0x80)
            point = lambda x: int(at[x - 1]) if x else 0
            every[i] = sorted((point(a), k, point(b)) for a, k, b in spans)
    return every


def find_secrets(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: list[str] | None = None,
    name: str = "secrets",
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col (or the columns keep) and an array of the spans found:
    kind (assign, access, hex, or crf for the random field's), start and end in code points,
    by start, then kind as listed.

    The random field learns from all windows of all documents. Null and empty texts have no
    spans. Repeated rows get a row each. Where no document holds a find of a pattern, the
    random field adds none."""
    model = train(docs, id_col, text_col, params)

    def make():
        def run(piece: Piece) -> dict[str, object]:
            return {name: [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in _spans(piece, model)]}
        return run

    fields = f"{name} array<struct<kind: string, start: long, end: long>>"
    return per_document(docs, text_col, make, fields, keep or [id_col])


def redact(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    mark: str = "[secret]",
    params: Params = Params(),
) -> DataFrame:
    """docs with each secret in text_col replaced by `mark`: of an assignment its value, of
    other spans the whole. Other columns, and texts without secrets, stay as they are."""
    model = train(docs, id_col, text_col, params)
    name = "redacted"

    def make():
        def run(piece: Piece) -> dict[str, object]:
            base, every = base_spans(piece), _spans(piece, model)
            texts = []
            for i in range(len(piece)):
                text = piece.text(i).decode()
                raw = piece.data[piece.offsets[i]:piece.offsets[i + 1]]
                point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)]) if base[i] else np.zeros(1, int)
                spans = [(int(point[secret]), int(point[end])) for _, _, end, secret in base[i]]
                spans += [(a, b) for a, k, b in every[i] if KINDS[k] == "crf"]
                out, at = [], 0
                for a, b in sorted(spans):
                    if a >= at:
                        out += [text[at:a], mark]
                    at = max(at, b)
                texts.append("".join(out) + text[at:])
            return {name: texts}
        return run

    while name in docs.columns:
        name += "_"
    rows = per_document(docs, text_col, make, f"{name} string", docs.columns)
    clean = F.when(F.col(text_col).isNotNull(), F.col(name))
    return rows.withColumn(text_col, clean).select(*docs.columns)


def secrets_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def many(kind: str):
        return F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("secrets", lambda x: x["kind"] != "crf")
    return found.select(
        id_col, many("assign").alias("n_assign"), many("access").alias("n_access"), many("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed("secrets").alias("spans"))
