"""Document fingerprints by spot signatures.

A signature is a chain of content words that follow a common word (an anchor). Texts that say
the same in other layout keep their signatures. A text's fingerprint is the set of its
signatures, each as 32 bits; likeness is the Jaccard similarity of two sets, and sets fall
into partitions by their length: those too far apart for a wanted likeness are never
compared."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from abono.llm.text import (
    LOWER, PIECE, Piece, joined_hash, per_document, piece_of, running_hash, span_hash, words_of,
)

#: Common words of four languages.
ANCHORS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with",
    "au aux avec ce dans de des du elle en et est il la le les leur mais ne ou par pas pour que qui se son sur un une",
    "als auf aus bei das dem den der des die ein eine er es für im in ist mit nicht sich sie und von war zu",
    "al como con de del el en es la las lo los más no para por que se su un una y",
)


@dataclass(frozen=True)
class Params:
    anchors: tuple[str, ...] = tuple(sorted({w for line in ANCHORS for w in line.split()}))
    #: Content words of a chain, and the distance between those.
    chain: int = 3
    distance: int = 1


def signatures(piece: Piece, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 32-bit signatures of each text, and cuts. A text without any, or with
    fewer content words than a chain, has one of all its words; one without words has one of
    all its bytes; an empty text has none."""
    words = words_of(piece)
    running = running_hash(LOWER[piece.data])
    h = span_hash(running, words.start, words.end)
    common = piece_of(list(p.anchors))
    stops = np.sort(span_hash(running_hash(common.data), common.offsets[:-1], common.offsets[1:]))
    at = np.minimum(np.searchsorted(stops, h), len(stops) - 1)
    anchor = stops[at] == h
    text = words.text_of()
    content = np.flatnonzero(~anchor)
    spots = np.flatnonzero(anchor)
    # the content word after the anchor, and those that follow at the distance
    nth = np.searchsorted(content, spots)[:, None] + np.arange(p.chain) * p.distance
    inside = nth[:, -1] < len(content)
    spots, nth = spots[inside], nth[inside]
    whole = text[content[nth[:, -1]]] == text[spots] if len(spots) else np.zeros(0, bool)
    spots, nth = spots[whole], nth[whole]
    chain = h[spots]
    for k in range(p.chain):
        chain = joined_hash(np.stack([chain, h[content[nth[:, k]]]], axis=1).reshape(-1), 2)[::2] if len(chain) else chain
    owner = text[spots]
    bare = np.flatnonzero((np.bincount(owner, minlength=len(piece)) == 0) & (np.diff(piece.offsets) > 0))
    extra = []
    for i in bare.tolist():
        own = h[words.cuts[i]:words.cuts[i + 1]]
        extra.append(joined_hash(own, len(own))[0] if len(own) else span_hash(running, piece.offsets[i:i + 1], piece.offsets[i + 1:i + 2])[0])
    chain = np.concatenate([chain, np.array(extra, dtype=np.uint64)])
    flat = np.unique((np.concatenate([owner, bare]).astype(np.uint64) << np.uint64(32)) | (chain >> np.uint64(32)))
    cuts = np.searchsorted(flat >> np.uint64(32), np.arange(len(piece) + 1, dtype=np.uint64))
    return (flat & np.uint64(0xFFFFFFFF)).astype(np.uint32), cuts


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity; 1 for two empty sets. With `least` above 0, 0 instead for sets of
    partitions that are no neighbours."""
    if not len(a) and not len(b):
        return 1.0
    if least > 0:
        one, two = length_partition(np.array([len(a), len(b)]), least)
        if abs(one - two) > 1:
            return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprint(signs: np.ndarray) -> str:
    """The set as hexadecimal text, eight digits a signature, rising."""
    return signs.astype(">u4").tobytes().hex()


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", params: Params = Params()) -> DataFrame:
    """One row per row of docs: id_col and fingerprint. Equal texts have equal ones; null and
    empty texts have an empty one."""
    def make():
        def run(piece: Piece) -> dict[str, object]:
            signs, cuts = signatures(piece, params)
            return {"fingerprint": [fingerprint(signs[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]}
        return run
    return per_document(docs, text_col, make, "fingerprint string", [id_col])


def length_partition(size: np.ndarray, least: float) -> np.ndarray:
    """Number of each set's partition: sets of likeness `least` or more are in one partition
    or in neighbouring ones."""
    return np.where(size > 0, np.floor(np.log(np.maximum(size, 1)) / -np.log(least)) + 1, 0).astype(np.int64)


def with_ghosts(docs: DataFrame, id_col: str, text_col: str, per_partition: int) -> DataFrame:
    """Rows (bucket, ghost, id, t): buckets are ranges of ids, and each bucket also has the
    first rows of the next one, as ghosts; the last one has those of the first. So in order of
    (ghost, id, t) each row but ghosts is followed by the next document. Only the ranges'
    bounds and their least ids reach the driver."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * per_partition
    bounds = rows.where("id is not null").approxQuantile("id", [i / n for i in range(1, n)], 0.1 / n)
    places = F.array(*[F.lit(x) for x in sorted(set(bounds))]).cast("array<double>")
    rank = F.size(F.filter(places, lambda x: x <= F.col("id")))
    rows = rows.withColumn("bucket", F.coalesce(F.when(F.col("id").isNull(), 0).otherwise(rank), F.lit(0)))
    least = rows.groupBy("bucket").agg(F.min(F.struct("id"))["id"].alias("first")).orderBy("bucket").collect()
    if not least:
        return rows.withColumn("ghost", F.lit(False))
    kind = docs.schema[id_col].dataType.simpleString()
    ahead = [(least[k - 1]["bucket"], row["first"]) for k, row in enumerate(least)]
    heads = docs.sparkSession.createDataFrame(ahead, f"before int, first {kind}")
    ghosts = rows.join(F.broadcast(heads), F.col("id").eqNullSafe(F.col("first")))
    ghosts = ghosts.select("id", "t", F.col("before").alias("bucket"), F.lit(True).alias("ghost"))
    return rows.withColumn("ghost", F.lit(False)).unionByName(ghosts)


def edited(text: str, following: str) -> str:
    """The text, its last quarter replaced by as much of the beginning of the following one."""
    size = len(text) // 4
    return text[:len(text) - size] + following[:size]


def compared_to_next(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    per_partition: int = 4,
    params: Params = Params(),
) -> DataFrame:
    """One row per row of docs: id_col, n_chars, edited (the text with its last quarter
    replaced by the beginning of the next document's), fingerprint and edited_fingerprint,
    near_edited and near_next (likeness of the fingerprint to the edited text's and to the
    next document's).

    Documents follow each other by id, which must be a number, then by text; null ids come
    first, and the first document follows the last. Null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple[object, str]]) -> pa.RecordBatch:
            """Of all rows but the last."""
            texts = [t for _, t in rows]
            new = [edited(a, b) for a, b in pairwise(texts)]
            signs, cuts = signatures(piece_of(texts), params)
            other, ends = signatures(piece_of(new), params)
            own = [signs[a:b] for a, b in pairwise(cuts)]
            changed = [other[a:b] for a, b in pairwise(ends)]
            return pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in rows[:-1]], type=id_kind), pa.array([len(t) for t in texts[:-1]], type=pa.int64()), pa.array(new, type=pa.string()),
                pa.array([fingerprint(x) for x in own[:-1]], type=pa.string()), pa.array([fingerprint(x) for x in changed], type=pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, changed)], type=pa.float64()),
                pa.array([likeness(a, b) for a, b in pairwise(own)], type=pa.float64())],
                names=[id_col, "n_chars", "edited", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        held: list[tuple[object, str]] = []
        bucket, done, size = None, False, 0
        for batch in batches:
            for own, ghost, k, text in zip(*(c.to_pylist() for c in batch.columns)):
                if own != bucket:
                    held, bucket, done, size = [], own, False, 0
                if done:
                    continue
                held.append((k, text))
                size += len(text)
                if len(held) > 1 and (ghost or size > PIECE):
                    yield made(held)
                    held, size = held[-1:], len(text)
                done = ghost

    id_kind = to_arrow_type(docs.schema[id_col].dataType)
    rows = with_ghosts(docs, id_col, text_col, per_partition).select("bucket", "ghost", "id", "t")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "ghost", "id", "t")
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def next_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(
        id_col, "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next")
