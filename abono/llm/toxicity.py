"""Toxicity by maximum-scoring segments.

Words and their beginnings have log-odds between toxic and other labelled documents, under a
Dirichlet prior with the shares in all documents, whose weight is a share of the words counted in
the rarer class; they are shrunk by some standard errors towards 0. A word's score is that of itself or of one of its beginnings, whichever is the farthest from 0,
less a drift. A linear scan finds every maximal segment of a text's word scores. How high
segments rise by chance follows an extreme-value law, fitted to the best segments of labelled
documents that are not toxic; a segment counts if its expected number in such a text is
small. A document's score is a logistic function of its best segment's significance and of
that of all its segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abono.llm.labelled import labelled
from abono.llm.store import stored
from abono.llm.text import (
    LOWER, Piece, joined_hash, mixed, per_document, running_hash, sliced, span_hash, word_hashes, words_of,
)


@dataclass(frozen=True)
class Params:
    #: Words share this many counters; the tables sent to executors are of this size.
    slots_log2: int = 21
    #: Sketches by which near copies are told in the sample.
    sketches: int = 4
    #: Weight of the prior, as a share of the words of the label with fewer. This and `significant`
    #: had about the least log loss across folds of the rows that may be learned from.
    prior_share: float = 0.3
    #: Weight of the prior in words instead, where given.
    prior: float | None = None
    #: Standard errors by which log-odds shrink.
    significant: float = 2.0
    #: Bytes of the beginnings that count beside the whole word.
    stems: tuple[int, ...] = (4, 5)
    drift: float = 0.5
    #: Expected number of chance segments below which a segment counts.
    expect: float = 0.05
    #: Bound of the labelled documents that are learned from (twice that at most).
    sample: int = 20_000


def _slots(piece: Piece, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """A row of slots per word, of the word and its beginnings, and the cuts between texts."""
    words = words_of(piece)
    running = running_hash(LOWER[piece.data])
    forms = [span_hash(running, words.start, words.end)]
    for k, size in enumerate(p.stems, start=1):
        end = np.minimum(words.start + size, words.end)
        forms.append(mixed(span_hash(running, words.start, end) + np.uint64(k)))
    return (np.stack(forms, axis=1) >> np.uint64(64 - p.slots_log2)).astype(np.int64), words.cuts


def word_counts(docs: DataFrame, text_col: str, group: Column, p: Params) -> DataFrame:
    """(group, slot, n): texts with a word, by slot and group, an int; summed in each task.
    A word counts once per text, so that a text that repeats it is no more than one witness."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for rows, piece in sliced(batch, 1):
                slots, cuts = _slots(piece, p)
                text = np.repeat(np.arange(len(piece)), np.diff(cuts))
                once = np.unique((text[:, None] << p.slots_log2) | slots)
                slots = once & ((1 << p.slots_log2) - 1)
                groups = rows.column(0).to_numpy(zero_copy_only=False)[once >> p.slots_log2]
                for g in np.unique(groups).tolist():
                    n = np.bincount(slots[groups == g], minlength=1 << p.slots_log2)
                    totals[g] = totals[g] + n if g in totals else n
        for g, n in totals.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"g": np.full(len(at), g, np.int32), "slot": at.astype(np.int32), "n": n[at]})

    rows = docs.select(group.cast("int").alias("g"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, "g int, slot int, n long").groupBy("g", "slot").agg(F.sum("n").alias("n"))


def segments(scores: np.ndarray, cuts: np.ndarray) -> list[list[tuple[int, int, float]]]:
    """All maximal scoring segments (start, end, score) of each text, in linear time.

    Every text's scores are cut into runs of positive ones; the sums between come from one
    running total. Each run joins earlier ones as long as the whole beats its parts."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    up = scores > 0
    first, last = up.copy(), up.copy()
    first[1:] &= ~up[:-1]
    last[:-1] &= ~up[1:]
    edges = cuts[1:-1]
    edges = edges[(edges > 0) & (edges < len(up))]
    first[edges], last[edges - 1] = up[edges], up[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    runs = np.searchsorted(starts, cuts)
    found = []
    for i in range(len(cuts) - 1):
        a, b = runs[i], runs[i + 1]
        found.append(_maximal(starts[a:b] - cuts[i], ends[a:b] - cuts[i], total[starts[a:b]], total[ends[a:b]]) if a < b else [])
    return found


def _maximal(starts: np.ndarray, ends: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int, float]]:
    """Segments as candidates with the totals before and after them. lower[j] is the last
    candidate before j with a smaller total before it, found by following earlier answers."""
    kept: list[list] = []
    lower: list[int] = []
    for s, e, lo, hi in zip(starts.tolist(), ends.tolist(), left.tolist(), right.tolist()):
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= lo:
                j = lower[j]
            if j < 0 or kept[j][3] >= hi:
                kept.append([s, e, lo, hi])
                lower.append(j)
                break
            s, lo = kept[j][0], kept[j][2]
            del kept[j:], lower[j:]
    return [(s, e, hi - lo) for s, e, lo, hi in kept]


def one_of_copies(docs: DataFrame, text_col: str, p: Params) -> DataFrame:
    """Labelled texts without most near copies: of those with one of several least hashes of
    three neighbouring words the same, one stays, so that copies are one witness, not many: that of
    the least text hash, of equal ones the least id, wherever the rows lie. Short texts compare by
    all words."""
    names = [f"__least{k}" for k in range(p.sketches)]

    def make():
        def run(piece: Piece) -> dict[str, object]:
            words = words_of(piece)
            h = word_hashes(piece, words)
            least = np.zeros((p.sketches, len(piece)), dtype=np.uint64)
            for i in range(len(piece)):
                own = h[words.cuts[i]:words.cuts[i + 1]]
                if len(own):
                    runs = joined_hash(own, min(3, len(own)))
                    least[:, i] = [mixed(runs + np.uint64(k)).min() for k in range(p.sketches)]
            return dict(zip(names, least.view(np.int64)))
        return run

    rows = per_document(docs, text_col, make, ", ".join(f"{x} long" for x in names), docs.columns)
    rows = rows.withColumn("__th", F.xxhash64(text_col))
    for name in names:
        others = [c for c in rows.columns if c not in (name, "__label", "__th")]
        first = F.min(F.struct("__th", *others)).alias("__first")
        rows = rows.groupBy(name, "__label").agg(first).select(name, "__label", "__first.*")
    return rows.select(*docs.columns)


@dataclass
class Model:
    odds: np.ndarray
    rate: float
    size: float
    weights: np.ndarray
    p: Params

    def scores(self, slots: np.ndarray) -> np.ndarray:
        odds = self.odds[slots]
        form = np.abs(odds).argmax(axis=1)
        # multiples of 1/1024 add up exactly, so equal texts have equal scores wherever they stand
        return np.round((odds[np.arange(len(odds)), form].astype(np.float64) - self.p.drift) * 1024) / 1024

    def evidence(self, n_words: int, found: list[tuple[int, int, float]]) -> tuple[float, float, int, int, int]:
        """Of the best segment -log of the chance of one as high; of the segments that count
        the sum of -log of their expected numbers; their number; place of the best."""
        best, total, count, where = 0.0, 0.0, 0, (0, 0)
        for s, e, score in found:
            expected = self.rate * score - np.log(max(self.size * max(n_words, 1), 1e-9))
            chance = -np.log(-np.expm1(-np.exp(min(-expected, 30.0)))) if expected < 30 else expected
            if chance > best:
                best, where = float(chance), (s, e)
            if expected > -np.log(self.p.expect):
                total += float(expected)
                count += 1
        return best, total, count, *where

    def inputs(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(best)), np.log1p(best), np.log1p(total)], axis=1)

    def probability(self, best: np.ndarray, total: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.inputs(best, total) @ self.weights, -50, 50)))


def log_odds(every: np.ndarray, toxic: np.ndarray, other: np.ndarray, p: Params) -> np.ndarray:
    """Log-odds by slot, shrunk towards 0."""
    weight = max(p.prior_share * min(toxic.sum(), other.sum()), 1.0) if p.prior is None else p.prior
    prior = weight * (every + 1e-3) / (every.sum() + 1e-3 * len(every))
    def odds(n: np.ndarray) -> np.ndarray:
        return np.log((n + prior) / (n.sum() + weight - n - prior))
    delta = odds(toxic) - odds(other)
    error = np.sqrt(1 / (toxic + prior) + 1 / (other + prior))
    return (np.sign(delta) * np.maximum(np.abs(delta) - p.significant * error, 0)).astype(np.float32)


def extreme_value(best: np.ndarray, n_words: np.ndarray) -> tuple[float, float]:
    """(rate, size) of the law of the best chance score of n words, a Gumbel law around
    log(size * n) / rate, from its mean and variance over texts without toxic words. Where these
    texts have no segments, or all the same, the rate is that of log-odds, 1, and one segment is
    expected in all of their words."""
    if len(best) < 2 or best.var() == 0:
        return 1.0, 1.0 / max(float(n_words.sum()), 1.0)
    log_n = np.log(n_words)
    rate = float(np.sqrt((np.pi**2 / 6 + log_n.var()) / best.var()))
    return rate, float(np.exp(np.clip(np.mean(rate * best - log_n) - np.euler_gamma, -30, 10)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method; the constant is not shrunk."""
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), ridge)
    keep[0] = 1e-6
    for _ in range(30):
        prob = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (prob - y) + keep * w
        hessian = (x * (prob * (1 - prob) + 1e-9)[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _counts(table: pa.Table, p: Params) -> dict[int, np.ndarray]:
    group, slot, n = (table[c].to_numpy() for c in ("g", "slot", "n"))
    return {g: np.bincount(slot[group == g], weights=n[group == g], minlength=1 << p.slots_log2) for g in (0, 1)}


def _measured(docs: DataFrame, model: Model, text_col: str, keep: list[str]) -> DataFrame:
    p = model.p

    def make():
        def run(piece: Piece) -> dict[str, object]:
            slots, cuts = _slots(piece, p)
            n_words = np.diff(cuts)
            rows = [model.evidence(int(n), found) for n, found in zip(n_words, segments(model.scores(slots), cuts))]
            best, total, count, start, end = (np.array(x) for x in zip(*rows))
            return {"score": model.probability(best, total), "n_words": n_words, "log_p": best, "log_e": total,
                    "n_segments": count, "best_start": start, "best_end": end}
        return run

    fields = "score double, n_words long, log_p double, log_e double, n_segments long, best_start long, best_end long"
    return per_document(docs, text_col, make, fields, keep)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, allowed: Column, p: Params) -> Model:
    sample = labelled(labels, id_col, label_col, allowed, p.sample)
    marked = stored(one_of_copies(docs.select(id_col, text_col).join(F.broadcast(sample), id_col), text_col, p), "labelled")
    every = _counts(word_counts(docs, text_col, F.lit(0), p).toArrow(), p)[0]
    counts = _counts(word_counts(marked, text_col, F.col("__label"), p).toArrow(), p)
    model = Model(log_odds(every, counts[1], counts[0], p), 1.0, 1.0, np.zeros(3), p)
    best = _best_scores(marked, model, text_col)
    label, n_words, top = _in_order(best, "__label", "n_words", "top")
    calm = (label == 0) & (n_words > 0)
    model.rate, model.size = extreme_value(top[calm], n_words[calm])
    measured = _measured(marked, model, text_col, ["__label"]).select("__label", "log_p", "log_e").toArrow()
    y, log_p, log_e = _in_order(measured, "__label", "log_p", "log_e")
    if 0 < y.sum() < len(y):
        model.weights = logistic(model.inputs(log_p, log_e), y.astype(float))
    else:
        share = (y.sum() + 1) / (len(y) + 2)
        model.weights = np.array([np.log(share / (1 - share)), 0.0, 0.0])
    return model


def _in_order(rows: pa.Table, *names: str) -> list[np.ndarray]:
    """Columns sorted by all of them, so that sums of floats don't depend on where rows lay."""
    columns = [rows[c].to_numpy() for c in names]
    order = np.lexsort(columns)
    return [c[order] for c in columns]


def _best_scores(docs: DataFrame, model: Model, text_col: str) -> pa.Table:
    p = model.p

    def make():
        def run(piece: Piece) -> dict[str, object]:
            slots, cuts = _slots(piece, p)
            found = segments(model.scores(slots), cuts)
            return {"n_words": np.diff(cuts), "top": [max((x[2] for x in f), default=0.0) for f in found]}
        return run

    return per_document(docs, text_col, make, "n_words long, top double", ["__label"]).toArrow()


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    allowed: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    keep: list[str] | None = None,
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col (or the columns keep), score (probability of label 1),
    n_words, log_p and log_e (evidence of the best and of all significant segments),
    n_segments (those that count), best_start and best_end (words of the best, from 0).

    Learns from about params.sample of the labelled rows that `allowed` admits; word shares
    come from all documents. Null and empty texts have no segments and get the score of no
    evidence. Repeated rows get equal scores, and scores are the same however rows are spread over
    files or partitions. Without labels of both kinds all scores are
    the same."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, allowed=allowed, p=params)
    return _measured(docs, model, text_col, keep or [id_col])
