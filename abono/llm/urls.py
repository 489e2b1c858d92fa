"""URL filters: rules for hosts and paths, and character language models where no rule fits.

Two variable-order Markov models, one of accepted and one of rejected URLs, give each
character a probability that blends all context lengths, longer ones the more they have been
seen. The difference of both log-likelihoods per character, less a threshold calibrated on
held-out URLs, decides. Counts cover all labelled URLs, the held-out ones too once the
threshold is set, and are kept for each distinct context and character, so the models sent to
executors grow with the distinct ones of at most six characters, not with the URLs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abono.llm.text import LOWER, Piece, per_document, running_hash, sliced, span_hash, sums_by


@dataclass(frozen=True)
class Params:
    #: Characters of context at most.
    order: int = 5
    #: Of ten labelled URLs one calibrates the threshold.
    held_out: int = 10


@dataclass(frozen=True)
class Rule:
    """`text` is a host, then a path; it fits the host and its subdomains, and paths that
    begin with its path."""

    verdict: str
    text: str

    @property
    def parts(self) -> tuple[str, str]:
        host, slash, path = self.text.partition("/")
        return host, slash + path


#: The rules of the registered query.
RULES = (
    Rule("allow", "org/"), Rule("block", "example.org/es/"), Rule("block", "example.org/en/1"),
    Rule("allow", "com/fr/"), Rule("block", "com/de/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for URLs without ://; only A-Z are lower-cased."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else nulls; of equal lengths the last."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        own_host, own_path = rule.parts
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _grams(piece: Piece, p: Params) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hashes of the context, of context and character) for each character of the
    URLs with contexts of each length; shorter at a URL's start."""
    running = running_hash(LOWER[piece.data])
    end = np.arange(1, len(piece.data) + 1)
    begin = np.repeat(piece.offsets[:-1], np.diff(piece.offsets))
    for k in range(p.order + 1):
        start = np.maximum(end - 1 - k, begin)
        yield k, span_hash(running, start, end - 1).view(np.int64), span_hash(running, start, end).view(np.int64)


def gram_counts(urls: DataFrame, p: Params) -> DataFrame:
    """urls: (label int, url). (part, gram, bad, good): sightings of each gram with either
    label, part being twice the context length, one more with the character; summed in each
    piece, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, piece in sliced(batch, 1):
                label = np.repeat(rows.column(0).to_numpy(), np.diff(piece.offsets))
                for k, *both in _grams(piece, p):
                    for with_it, h in enumerate(both):
                        gram, at = np.unique(h, return_inverse=True)
                        good = np.bincount(at, weights=label, minlength=len(gram)).astype(np.int64)
                        bad = np.bincount(at, minlength=len(gram)) - good
                        part = np.full(len(gram), 2 * k + with_it, np.int32)
                        yield pa.RecordBatch.from_pydict({"part": part, "gram": gram, "bad": bad, "good": good})

    rows = urls.mapInArrow(run, "part int, gram long, bad long, good long")
    return rows.groupBy("part", "gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


@dataclass
class Table:
    """Distinct grams, sorted, and the sightings of each with label 0 and 1."""

    gram: np.ndarray
    n: np.ndarray

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sightings of each of h with either label, 0 where it was never seen."""
        if not len(self.gram):
            return np.zeros(len(h)), np.zeros(len(h))
        own, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.gram, own), len(self.gram) - 1)
        found = np.where(self.gram[at] == own, self.n[:, at], 0)
        return found[0][back], found[1][back]


def tables_of(counts: pa.Table, p: Params) -> list[Table]:
    """A table of each part; equal grams are added up."""
    part, gram, *n = (counts[c].to_numpy() for c in ("part", "gram", "bad", "good"))
    out = []
    for k in range(2 * (p.order + 1)):
        own = part == k
        name, at = np.unique(gram[own], return_inverse=True)
        out.append(Table(name, np.stack([np.bincount(at, weights=x[own], minlength=len(name)) for x in n])))
    return out


@dataclass
class Model:
    tables: list[Table]
    threshold: float
    p: Params

    def rates(self, piece: Piece) -> np.ndarray:
        """Log-likelihood difference per character of each URL, 0 for empty ones."""
        prob = np.full((2, len(piece.data)), 1 / 256)
        weight = self.p.order + 1.0  # of what the shorter contexts say, in sightings
        for k, context, gram in _grams(piece, self.p):
            seen, with_it = self.tables[2 * k].of(context), self.tables[2 * k + 1].of(gram)
            for y in (0, 1):
                prob[y] = (with_it[y] + weight * prob[y]) / (seen[y] + weight)
        log = np.log(prob)
        return sums_by(log[1] - log[0], piece.offsets) / np.maximum(np.diff(piece.offsets), 1)


def _rated(urls: DataFrame, model: Model, url_col: str, keep: list[str]) -> DataFrame:
    def make():
        return lambda piece: {"rate": model.rates(piece)}
    return per_document(urls, url_col, make, "rate double", keep)


def calibrated(rates: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The threshold with the best mean of both labels' hit rates; of equal ones the middle
    of the widest gap, 0 if a label is missing."""
    order = np.argsort(rates, kind="stable")
    rates, labels, weight = rates[order], labels[order], weight[order]
    good, bad = (labels * weight).sum(), ((1 - labels) * weight).sum()
    if not good or not bad:
        return 0.0
    below = np.cumsum((1 - labels) * weight) / bad + (good - np.cumsum(labels * weight)) / good
    gap = np.diff(rates, append=rates[-1])
    best = np.flatnonzero(below >= below[:-1].max(initial=0) - 1e-12)
    best = best[best < len(rates) - 1]
    if not len(best):
        return 0.0
    k = best[np.argmax(gap[best])]
    return float((rates[k] + rates[k + 1]) / 2)


def train(urls: DataFrame, p: Params) -> Model:
    """urls: (label int 0 or 1, url) of all labelled URLs."""
    held = F.pmod(F.xxhash64("url"), F.lit(p.held_out)) == 0
    counts = gram_counts(urls.where(~held), p).toArrow()
    model = Model(tables_of(counts, p), 0.0, p)
    # a histogram of the held-out rates: its size does not depend on the number of URLs
    rated = _rated(urls.where(held), model, "url", ["label"])
    cell = F.round(F.col("rate") * 1000).cast("long")
    found = rated.groupBy("label", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    rates, labels, n = (found[c].to_numpy() for c in ("cell", "label", "n"))
    threshold = calibrated(rates / 1000, labels.astype(float), n.astype(float))
    # the held-out URLs count as well once the threshold is set
    rest = gram_counts(urls.where(held), p).toArrow()
    return Model(tables_of(pa.concat_tables([counts, rest]), p), threshold, p)


def filter_urls(
    pages: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Sequence[Rule] = RULES,
    params: Params = Params(),
) -> DataFrame:
    """One row per row of pages: id_col, host, path, rule, verdict, and rate (the models'
    log-likelihood difference per character less the threshold).

    URLs that a rule fits are what the models learn from, and keep the rule's verdict; for
    all others the verdict is allow if rate is 0 or more. Null and empty URLs have rate 0 less
    the threshold; without labelled URLs of both kinds all others are allowed. Repeated rows
    get a row each."""
    url = F.col(url_col).cast("string")
    host, path = host_and_path(F.col("__url"))
    rows = pages.select(id_col, url.alias("__url")).withColumns({"host": host, "path": path})
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__verdict": verdict})
    labelled = rows.where("rule is not null").select((F.col("__verdict") == "allow").cast("int").alias("label"), F.col("__url").alias("url"))
    model = train(labelled, params)
    rated = _rated(rows, model, "__url", [id_col, "host", "path", "rule", "__verdict"])
    rate = F.col("rate") - F.lit(model.threshold)
    return rated.select(
        id_col, "host", "path", "rule",
        F.coalesce("__verdict", F.when(rate >= 0, "allow").otherwise("block")).alias("verdict"), rate.alias("rate"))
