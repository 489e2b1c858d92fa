"""Quality classifier: averaged embeddings of hashed words and character n-grams.

A document is the mean of the vectors of its words and of the n-grams inside its words (with
the neighbouring spaces as word boundaries); a softmax over two classes follows. Vectors and
output are learned together by stochastic gradient descent on a bounded sample of labelled
documents. As the output is linear in the mean, a learned model is one number per hash slot,
and scoring is a mean of table entries."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abono.llm.labelled import labelled
from abono.llm.text import (
    SOLID, Piece, inner_runs, joined_hash, list_array, per_document, running_hash, span_hash, sums_by, words_of,
)

_SPACES = np.arange(256, dtype=np.uint8)
_SPACES[[9, 10, 11, 12, 13]] = 32


@dataclass(frozen=True)
class Params:
    slots_log2: int = 17
    grams: tuple[int, ...] = (3, 4)
    dims: int = 16
    epochs: int = 4
    rate: float = 1.0
    seed: int = 7
    #: Bound of the labelled documents that are learned from (twice that at most).
    sample: int = 4_000


def features(piece: Piece, p: Params) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature (slot of each occurrence in text order, cuts by text): words,
    words that repeat the one before, repeated runs of three words, n-grams."""
    drop = np.uint64(64 - p.slots_log2)
    data = _SPACES[piece.data]
    running = running_hash(data)
    words = words_of(piece, SOLID)
    h = span_hash(running, words.start, words.end)
    kinds = [((h >> drop).astype(np.int64), words.cuts)]
    again = np.zeros(len(h), dtype=bool)
    again[1:] = h[1:] == h[:-1]
    kinds.append(_marked(again, words.cuts, 0))
    starts, count = inner_runs(words.cuts, 3)
    runs = joined_hash(h, 3)[starts] + np.repeat(np.arange(len(count), dtype=np.uint64), count) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(runs, kind="stable")
    seen = np.zeros(len(runs), dtype=bool)
    seen[order[1:]] = runs[order[1:]] == runs[order[:-1]]
    kinds.append(_marked(seen, np.concatenate([[0], np.cumsum(count)]), 1))
    space = np.concatenate([[0], np.cumsum(data == 32)])
    for n in p.grams:
        at = np.arange(max(len(data) - n + 1, 0))
        inside = space[at + n - 1] == space[at + 1] if len(at) else np.zeros(0, bool)
        edges = piece.offsets[1:-1, None] - np.arange(1, n)
        edges = edges[(edges >= 0) & (edges < len(at))]
        inside[edges] = False
        at = at[inside]
        kinds.append(((span_hash(running, at, at + n) >> drop).astype(np.int64), np.searchsorted(at, piece.offsets)))
    return kinds


def _marked(flags: np.ndarray, cuts: np.ndarray, slot: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(flags)
    return np.full(len(at), slot, dtype=np.int64), np.searchsorted(at, cuts)


def vectors(docs: DataFrame, text_col: str, keep: list[str], p: Params) -> DataFrame:
    """The columns keep, and each text's feature slots with their share of all its features."""
    def make():
        def run(piece: Piece) -> dict[str, object]:
            kinds = features(piece, p)
            slots, shares, cuts = [], [], [0]
            for i in range(len(piece)):
                every = np.concatenate([s[c[i]:c[i + 1]] for s, c in kinds])
                slot, count = np.unique(every, return_counts=True)
                slots.append(slot)
                shares.append(count / max(1, len(every)))
                cuts.append(cuts[-1] + len(slot))
            at = np.array(cuts)
            return {"slots": list_array(np.concatenate(slots), at, pa.int32()), "shares": list_array(np.concatenate(shares), at, pa.float32())}
        return run
    return per_document(docs, text_col, make, "slots array<int>, shares array<float>", keep)


@dataclass
class Model:
    table: np.ndarray
    bias: float


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], p: Params) -> Model:
    """rows: (label, slots, shares). Without rows of both labels the score is the share of
    label 1, or a half without any row."""
    size = 1 << p.slots_log2
    positive = sum(y for y, _, _ in rows)
    if not 0 < positive < len(rows):
        share = (positive + 1) / (len(rows) + 2)
        return Model(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(p.seed)
    embed = rng.uniform(-1 / p.dims, 1 / p.dims, (size, p.dims)).astype(np.float32)
    out = np.zeros((p.dims, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    total, step = p.epochs * len(rows), 0
    for _ in range(p.epochs):
        for k in rng.permutation(len(rows)):
            label, slots, shares = rows[k]
            rate = p.rate * (1 - step / total)
            step += 1
            mean = shares @ embed[slots]
            logits = mean @ out + bias
            prob = np.exp(logits - logits.max())
            error = prob / prob.sum()
            error[label] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            embed[slots] -= (rate * len(slots) ** 0.5) * np.outer(shares, back)
    return Model((embed @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, allowed: Column, p: Params) -> Model:
    sample = labelled(labels, id_col, label_col, allowed, p.sample)
    marked = docs.select(id_col, text_col).join(F.broadcast(sample), id_col)
    table = vectors(marked, text_col, [id_col, "__label"], p).toArrow().sort_by(id_col)
    rows = [
        (int(y), np.asarray(slots.values), np.asarray(shares.values))
        for y, slots, shares in zip(table["__label"].to_pylist(), table["slots"], table["shares"])]
    return fit(rows, p)


def score(docs: DataFrame, model: Model, *, text_col: str = "text", keep: list[str], p: Params, name: str = "score") -> DataFrame:
    def make():
        def run(piece: Piece) -> dict[str, object]:
            total, count = np.zeros(len(piece)), np.zeros(len(piece), np.int64)
            for slots, cuts in features(piece, p):
                total += sums_by(model.table[slots].astype(np.float64), cuts)
                count += np.diff(cuts)
            return {name: 1 / (1 + np.exp(-(total / np.maximum(count, 1) + model.bias)))}
        return run
    return per_document(docs, text_col, make, f"{name} double", keep)


def quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    keep: list[str] | None = None,
    name: str = "score",
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col (or the columns keep) and the probability of label 1.

    Learns from about params.sample of the labelled rows that `allowed` admits. Null and empty
    texts have no features and get the score of the bias alone. Repeated rows get equal
    scores. Without labels of both kinds every score is the same."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, allowed=allowed, p=params)
    return score(docs, model, text_col=text_col, keep=keep or [id_col], p=params, name=name)
