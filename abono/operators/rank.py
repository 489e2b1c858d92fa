"""Rank filters per key and exact global n-tiles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window, functions as F
from pyspark.sql.types import (
    ByteType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField,
    StructType)

from abono.operators.shared import materialize


def top_n_per_key(df: DataFrame, key, order: list[Column], n: int = 1,
                  rank: str | None = None) -> DataFrame:
    """The first n rows of each key. Spark limits every map task to n rows per key before
    the shuffle, so a hot key reaches its task already reduced."""
    keys = [key] if isinstance(key, str) else list(key)
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(rank or "_rn", F.row_number().over(w))
    kept = ranked.filter(F.col(rank or "_rn") <= n)
    return kept.withColumn(rank, F.col(rank).cast("bigint")) if rank else kept.drop("_rn")


def newest_per_key(df: DataFrame, key, cursor: str, tiebreak: list[str] | None = None) -> DataFrame:
    order = [F.col(c).desc_nulls_last() for c in [cursor, *(tiebreak or [])]]
    return top_n_per_key(df, key, order)


def _common_type(df: DataFrame, metrics: list[str]) -> str:
    """One type that holds all metrics exactly."""
    whole = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
    types = [df.schema[m].dataType for m in metrics]
    if all(isinstance(t, (DoubleType, FloatType)) for t in types):
        return "double"
    digits, scale = 0, 0
    for name, t in zip(metrics, types):
        if isinstance(t, DecimalType):
            digits, scale = max(digits, t.precision - t.scale), max(scale, t.scale)
        elif type(t) in whole:
            digits = max(digits, whole[type(t)])
        else:
            raise TypeError(f"{name}: n-tiles need exact numbers, or only floating ones, not {t}")
    if digits + scale > 38:
        raise TypeError(f"no decimal holds {metrics} together")
    return f"decimal({digits + scale},{scale})"


def _tile_starts(rows: int, k: int) -> list[int]:
    """0-based rank of the first row of tiles 2..k; the first rows % k tiles get one more."""
    size, extra = divmod(rows, k)
    starts = [t * size + min(t, extra) for t in range(1, k)]
    return [s for s in starts if s < rows]


#: Cut points that a round of counting uses per span; rows that one task may sort.
CUTS, SORTED_ROWS = 512, 100_000
CHUNK = 32


@dataclass(frozen=True)
class _Span:
    """Rows of one score from low (inclusive) to high (exclusive) in the order of places: how
    many, how many come before, and the ranks wanted among all rows of the score."""

    score: int
    low: Row | None
    high: Row | None
    rows: int
    before: int
    wanted: tuple[int, ...]


class _Places:
    """Rows of all scores as (score, place); a place sorts by null, value and key."""

    def __init__(self, base: DataFrame, key: str, scores: list[tuple[str, str]], common: str):
        self.base, self.key, self.scores, self.common = base, key, scores, common
        self.kind = base.schema[key].dataType

    def here(self, i: int) -> Column:
        metric, way = self.scores[i]
        value = F.col(metric).cast(self.common)
        return F.struct(F.col(metric).isNull().alias("none"),
                        (-value if way == "desc" else value).cast(self.common).alias("value"),
                        F.col(self.key).alias("key"))

    def literal(self, place: Row) -> Column:
        return F.struct(F.lit(place["none"]).alias("none"), F.lit(place["value"]).cast(self.common).alias("value"),
                        F.lit(place["key"]).cast(self.kind).alias("key"))

    def within(self, spans: list[_Span]) -> DataFrame:
        """(span, place) of the rows in any of the spans, by their positions in the list. One scan of
        the key and the metrics; nothing is shuffled."""
        found = []
        for n, s in enumerate(spans):
            place = self.here(s.score)
            inside = F.lit(True)
            if s.low is not None:
                inside = inside & (place >= self.literal(s.low))
            if s.high is not None:
                inside = inside & (place < self.literal(s.high))
            found.append(F.when(inside, F.struct(F.lit(n).alias("span"), place.alias("place"))))
        rows = self.base.select(F.explode(F.array_compact(F.array(*found))).alias("r"))
        return rows.select("r.span", "r.place")


def _narrowed(places: _Places, spans: list[_Span], cuts: int) -> list[_Span]:
    """Each span cut at a sample of its own places, and of the pieces those with wanted ranks.
    The sample only says where to cut; every row is counted."""
    share = F.lit(0.0)
    for n, s in enumerate(spans):
        share = F.when(F.col("span") == n, cuts / s.rows).otherwise(share)
    grain = 1 << 30
    drawn = F.pmod(F.xxhash64("place.key", F.lit(len(spans))), F.lit(grain)) < share * grain
    sample = places.within(spans).filter(drawn).groupBy("span").agg(F.sort_array(F.collect_set("place")).alias("cuts"))
    points = {r["span"]: r["cuts"] for r in sample.collect()}
    schema = StructType([StructField("span", IntegerType()), StructField("cuts", sample.schema["cuts"].dataType)])
    sent = places.base.sparkSession.createDataFrame(list(points.items()), schema).select(
        "span", F.transform(F.sequence(F.lit(0), F.floor((F.size("cuts") - 1) / CHUNK).cast("int")),
                            lambda i: F.slice("cuts", i * CHUNK + 1, F.lit(CHUNK))).alias("chunks"))
    sent = sent.select("span", "chunks", F.transform("chunks", lambda c: c[0]).alias("heads"))
    place = F.col("place")
    chunk = F.size(F.filter("heads", lambda c: c <= place))
    inner = F.size(F.filter(F.get("chunks", chunk - 1), lambda c: c <= place))
    piece = F.when(chunk > 0, (chunk - 1) * CHUNK + inner).otherwise(0)
    # At most 2 * cuts points per span, and a span per tile and score.
    counted = places.within(spans).join(F.broadcast(sent), "span").groupBy("span", piece.alias("piece")).agg(F.count("*").alias("n"))
    sizes = {(r["span"], r["piece"]): r["n"] for r in counted.collect()}
    out = []
    for n, s in enumerate(spans):
        own = points.get(n, [])
        if not own:  # an unlucky draw
            out.append(s)
            continue
        edges, before = [s.low, *own, s.high], s.before
        for k in range(len(own) + 1):
            rows = sizes.get((n, k), 0)
            wanted = tuple(w for w in s.wanted if before <= w < before + rows)
            if wanted:
                out.append(_Span(s.score, edges[k], edges[k + 1], rows, before, wanted))
            before += rows
    return out


def _rows_at(places: _Places, ranks: dict[int, list[int]], rows: int, sorted_rows: int) -> dict[int, list[Row]]:
    """The places at the given ranks of each score, by counting: spans are cut until those that
    hold a wanted rank have few enough rows for one task to sort."""
    spans = [_Span(i, None, None, rows, 0, tuple(wanted)) for i, wanted in ranks.items() if wanted]
    cuts = CUTS
    while large := [s for s in spans if s.rows > sorted_rows]:
        cut = _narrowed(places, large, cuts)
        if cut == large and cuts > max(s.rows for s in large):
            break  # the key repeats: one place has all rows of the span
        cuts = cuts * 4 if cut == large else CUTS
        spans = [s for s in spans if s.rows <= sorted_rows] + cut
    if not spans:
        return {}
    wanted = F.lit(False)
    for n, s in enumerate(spans):
        wanted = wanted | ((F.col("span") == n) & F.col("at").isin([w - s.before for w in s.wanted]))
    by_place = Window.partitionBy("span").orderBy("place")
    found = places.within(spans).withColumn("at", F.row_number().over(by_place) - 1).filter(wanted).collect()
    out: dict[int, list[Row]] = {}
    for r in found:
        out.setdefault(spans[r["span"]].score, []).append(r["place"])
    return out


def exact_ntile(
    df: DataFrame,
    key: str,
    scores: dict[str, tuple[str, str]],
    k: int = 5,
    materialized: bool = False,
    sorted_rows: int = SORTED_ROWS,
) -> DataFrame:
    """Add {score: (metric, 'asc' | 'desc')} columns with ntile(k) over the whole table,
    ties broken by `key` (unique, not null), null metrics last; metrics hold no NaN.

    The built-in ntile moves every row to one task. Here the k - 1 rows where a tile starts are
    found by counting: rows between sampled cut points are counted, and only the stretch that
    holds such a row is cut again, until a task can sort it (sorted_rows). A value that most rows
    have is cut by key like any other stretch. Each round reads the key and the metrics; only
    counts and cut points are shuffled. A row's tile follows from comparing it with those rows.
    """
    common = _common_type(df, [m for m, _ in scores.values()])
    base = df if materialized else materialize(df, "metrics")
    rows = base.count()
    places = _Places(base, key, list(scores.values()), common)
    starts = _rows_at(places, {i: _tile_starts(rows, k) for i in range(len(scores))}, rows, sorted_rows)

    def tile(i: int) -> Column:
        result = F.lit(1).cast("bigint")
        for start in starts.get(i, []):
            result = result + (places.here(i) >= places.literal(start)).cast("bigint")
        return result

    return base.select("*", *[tile(i).alias(out) for i, out in enumerate(scores)])
