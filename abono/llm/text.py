"""Shared helpers: Arrow batches of documents as byte arrays, words, hashes, samples.

Operators that need Python read texts through `per_document`, which hands them to numpy as
UTF-8 bytes and offsets, a bounded piece at a time. A null text counts as an empty one."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text handled at once; one longer document is a piece of its own.
PIECE = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words: digits, letters and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

#: Bytes of words that only white space ends.
SOLID = np.ones(256, dtype=bool)
SOLID[[32, 9, 10, 11, 12, 13]] = False


@dataclass
class Piece:
    """Texts as one byte array; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


@dataclass
class Words:
    """Byte places of words; words cuts[i] to cuts[i + 1] are those of text i."""

    start: np.ndarray
    end: np.ndarray
    cuts: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.cuts) - 1), np.diff(self.cuts))


def piece_of(texts: Sequence[str | bytes | None]) -> Piece:
    raw = [b"" if t is None else t.encode() if isinstance(t, str) else t for t in texts]
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in raw], out=offsets[1:])
    return Piece(np.frombuffer(b"".join(raw), dtype=np.uint8), offsets)


def arrow_piece(column: pa.Array) -> Piece:
    """Bytes and offsets of a string or binary column, without making Python strings."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return Piece(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    flat = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return Piece(flat[at[0]:at[-1]], at - at[0])


def sliced(batch: pa.RecordBatch, column: int, size: int = PIECE) -> Iterator[tuple[pa.RecordBatch, Piece]]:
    """The batch in runs of rows of about `size` bytes of text at most."""
    whole = arrow_piece(batch.column(column))
    first = 0
    while first < len(whole):
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(whole))
        at = whole.offsets[first:last + 1]
        yield batch.slice(first, last - first), Piece(whole.data[at[0]:at[-1]], at - at[0])
        first = last


def per_document(
    docs: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[Piece], dict[str, object]]],
    fields: str,
    keep: Sequence[str],
    size: int = PIECE,
) -> DataFrame:
    """The columns `keep` of every row and the `fields` computed from its text.

    `make` runs once per task and returns the function from a piece to arrays, one entry per
    row. Other columns of docs are not read, so their names can't clash."""
    new = T.StructType.fromDDL(fields)
    kinds = [to_arrow_type(f.dataType) for f in new]
    n = len(keep)
    shared = text_col in keep and docs.schema[text_col].dataType == T.StringType()
    at = list(keep).index(text_col) if shared else n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for rows, piece in sliced(batch, at, size):
                made = f(piece)
                columns = [as_arrow(made[x.name], kind) for x, kind in zip(new, kinds)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:n], *columns], names=[*keep, *new.names])

    text = F.col(_quoted(text_col)).cast("string").alias("__text")
    picked = docs.select(*[F.col(_quoted(c)) for c in keep], *([] if shared else [text]))
    schema = T.StructType([*[docs.schema[c] for c in keep], *new.fields])
    return picked.mapInArrow(run, schema)


def as_arrow(values: object, kind: pa.DataType) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def words_of(piece: Piece, kept: np.ndarray = ALNUM) -> Words:
    """Maximal runs of bytes marked in `kept`, never across texts."""
    inside = kept[piece.data]
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(piece) + 1, np.int64))
    edges = piece.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(inside))]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(start, end, np.searchsorted(start, piece.offsets))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = max(n, PIECE + (1 << 16))
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


def running_hash(data: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] times the base to the power -i a hash of data[i:j]."""
    up, _ = _power(len(data) + 1)
    h = np.zeros(len(data) + 1, dtype=np.uint64)
    part = data.astype(np.uint64)
    part += np.uint64(1)
    part *= up[:-1]
    np.cumsum(part, out=h[1:])
    return h


def span_hash(running: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _power(len(running))
    h = running[end]
    h -= running[start]
    h *= down[start]
    return mixed(h)


def word_hashes(piece: Piece, words: Words, lower: bool = True) -> np.ndarray:
    return span_hash(running_hash(LOWER[piece.data] if lower else piece.data), words.start, words.end)


def joined_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k neighbouring entries; k - 1 entries shorter, empty if too few."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    out = mixed(h[:len(h) - k + 1] + np.uint64(k))
    for j in range(1, k):
        out = mixed(out * _BASE + h[j:len(h) - k + 1 + j])
    return out


def inner_runs(cuts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the runs of k entries that stay in one text, and each text's number of them."""
    count = np.maximum(np.diff(cuts) - k + 1, 0)
    return ranges(cuts[:-1], count), count


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... count[0] of them, then those of start[1], and so on."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(start - (np.cumsum(count) - count), count)
    return np.arange(total, dtype=np.int64) + shift


def sums_by(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of values[cuts[i]:cuts[i + 1]] for each i; cuts go from 0 to the end. Equal runs of
    numbers have equal sums, wherever they stand."""
    if values.dtype.kind != "f":
        total = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum(values, out=total[1:])
        return total[cuts[1:]] - total[cuts[:-1]]
    out = np.zeros(len(cuts) - 1)
    full = np.flatnonzero(np.diff(cuts) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, cuts[full])
    return out


def list_array(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values, type=kind))


def about(df: DataFrame, key: str, n: int) -> DataFrame:
    """About n rows of df, the same ones each time: those whose key's hash is low. With up to
    n rows it is all of them. Null keys are left out. At most 2 n rows."""
    total = df.count()
    df = df.where(F.col(key).isNotNull())
    if total <= n:
        return df
    low = int((n / total) * 2**31)
    return df.where(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(2**31)) < low).limit(2 * n)
