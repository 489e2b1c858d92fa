"""Data quality checks. Each yields rows of
(check_name, table_name, column_name, metric, status, detail); nothing but such rows is
ever collected."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, TimestampNTZType

from abono import fixed
from abono.functions import as_ts, is_email, moment

OK, WARNING, SKIP, ERROR = "OK", "WARNING", "SKIP", "ERROR"
RESULT = (
    "check_name string, table_name string, column_name string,"
    " metric bigint, status string, detail string")


def _result(df: DataFrame, check: str, table: str, column: str | None, metric: Column,
            status: Column | None = None, detail: Column | None = None) -> DataFrame:
    """Turn a one-row aggregate into a result row; zero findings are OK by default."""
    metric = metric.cast("bigint")
    if status is None:
        status = F.when(metric == 0, OK).otherwise(WARNING)
    return df.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).cast("string").alias("column_name"), metric.alias("metric"),
        status.alias("status"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"))


def stated(spark: SparkSession, check: str, table: str, column: str | None, status: str,
           detail: str, metric: int | None = None) -> DataFrame:
    """A result known without looking at data: SKIP or ERROR."""
    return spark.createDataFrame([(check, table, column, metric, status, detail)], RESULT)


def union_results(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


def check_counts(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """Row counts on both sides; the metric is source minus target."""
    none = F.lit(0).cast("bigint")
    both = source.agg(F.count("*").alias("s"), none.alias("t")).unionByName(
        target.agg(none.alias("s"), F.count("*").alias("t"))
    ).agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    return _result(both, "row_count", table, None, F.col("s") - F.col("t"),
                   detail=F.concat_ws(" -> ", "s", "t"))


def duplicate_keys(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("filas")).filter(F.col("filas") > 1)


def check_duplicates(df: DataFrame, key, table: str) -> DataFrame:
    """Number of duplicated keys; the keys themselves come from duplicate_keys."""
    if not key:
        return stated(df.sparkSession, "duplicates", table, None, SKIP, "no key known")
    keys = [key] if isinstance(key, str) else list(key)
    found = duplicate_keys(df, keys).agg(F.count("*").alias("n"))
    return _result(found, "duplicates", table, ",".join(keys), F.col("n"))


def check_unique(df: DataFrame, column: str, table: str) -> DataFrame:
    """Duplicated values; nulls are no duplicates."""
    found = duplicate_keys(df.filter(F.col(column).isNotNull()), column)
    return _result(found.agg(F.count("*").alias("n")), "unique", table, column, F.col("n"))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose reference leads nowhere; null references are no orphans."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.filter(F.col(fk).isNotNull()).join(
        keys, F.col(fk) == F.col("_pk"), "left_anti")


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str, table: str,
             parent_name: str = "", check: str = "foreign_key") -> DataFrame:
    """Number of orphan rows. Children are counted per reference before the join, so one
    popular parent does not weigh on a single task."""
    counted = child.groupBy(fk).agg(F.count("*").alias("n"))
    found = orphans(counted, fk, parent, pk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return _result(found, check, table, fk, F.col("n"),
                   detail=F.lit(f"parent {parent_name}" if parent_name else None))


def check_freshness(df: DataFrame, column: str, now, table: str,
                    hours: int = fixed.FRESHNESS_HOURS) -> DataFrame:
    """Age in seconds of the newest timestamp. Only a newest value after now - hours and
    not after now is OK; no value, a future one, or one at or before the limit warns."""
    if column not in df.columns:
        return stated(df.sparkSession, "freshness", table, None, SKIP, f"no column {column}")
    age, status, detail = _freshness(F.col("newest"), now, hours)
    return _result(df.agg(F.max(as_ts(column)).alias("newest")), "freshness", table, column,
                   age, status, detail)


def _freshness(newest: Column, now, hours: int) -> tuple[Column, Column, Column]:
    """Metric, status and detail of a newest moment."""
    at = moment(now)
    fresh = (newest <= at) & (newest > at - F.make_dt_interval(hours=F.lit(hours)))
    shown = F.date_format(newest, "yyyy-MM-dd HH:mm:ss")
    detail = (F.when(newest.isNull(), "no timestamps")
              .when(newest > at, F.concat(F.lit("future: "), shown))
              .when(fresh, F.concat(F.lit("fresh: "), shown))
              .otherwise(F.concat(F.lit("stale: "), shown)))
    return F.timestamp_diff("SECOND", newest, at), F.when(fresh, OK).otherwise(WARNING), detail


@dataclass(frozen=True)
class Rule:
    """A row-level check: counts the rows where `broken` holds."""

    check: str
    column: str
    broken: Column


def not_null(column: str) -> Rule:
    return Rule("not_null", column, F.col(column).isNull())


def accepted(column: str, values: list) -> Rule:
    """Nulls are not judged."""
    return Rule("accepted_values", column, ~F.col(column).isin(values))


def email_format(column: str, pattern: str = fixed.EMAIL_PATTERN) -> Rule:
    return Rule("email_format", column, ~is_email(column, pattern))


def minimum(column: str, low) -> Rule:
    return Rule("minimum", column, F.col(column) < F.lit(low))


def check_rules(df: DataFrame, rules: list[Rule], table: str) -> DataFrame:
    """All row-level checks of a table in one pass."""
    counted = df.agg(*[F.count_if(r.broken).alias(f"n{i}") for i, r in enumerate(rules)])
    rows = F.explode(F.array(*[
        F.struct(F.lit(r.check).alias("check"), F.lit(r.column).alias("column"),
                 F.col(f"n{i}").alias("n")) for i, r in enumerate(rules)]))
    return counted.select(rows.alias("r")).select(
        F.col("r.check").alias("check_name"), F.lit(table).alias("table_name"),
        F.col("r.column").alias("column_name"), F.col("r.n").alias("metric"),
        F.when(F.col("r.n") == 0, OK).otherwise(WARNING).alias("status"),
        F.lit(None).cast("string").alias("detail"))


@dataclass(frozen=True)
class Reference:
    """A column whose values must be keys of a parent table."""

    column: str
    parent: str
    parent_key: str
    check: str = "foreign_key"


@dataclass(frozen=True)
class Wanted:
    """All checks of a table that one pass can answer. unique: columns without repeated values,
    nulls aside; duplicates: columns without repeated values, null among them."""

    rules: list[Rule] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    duplicates: list[str] = field(default_factory=list)
    references: list[Reference] = field(default_factory=list)


#: Kinds of keys whose text is the same whenever they are equal, and only then.
KEY_TYPES = (IntegralType, StringType, DateType, TimestampNTZType)


def fused(tables: dict[str, DataFrame], wanted: dict[str, Wanted]) -> DataFrame:
    """Results of all wanted checks from one scan of each table and one shuffle.

    Every row is handed out as (space, value, role): a key column's value in that column's space,
    in role 0; a reference's value in its parent key's space, in a role of its own; and, for each
    rule that the row breaks, that rule. Counted per space and value, combined in the map tasks,
    a key that repeats has several of role 0, and what no parent has, none: no join is needed, and
    a popular value weighs as little as any other. Parents that aren't checked for anything else
    are scanned for their keys. Checks of keys of other types than KEY_TYPES are made one by one."""
    spark = next(iter(tables.values())).sparkSession
    spaces: dict[tuple[str, str], int] = {}
    roles: dict[int, int] = {}
    rules = 0
    asked: list[tuple[int, int, str, str, str | None, str | None]] = []
    emitted: dict[str, list[Column]] = {}
    in_role_0: set[tuple[str, str]] = set()

    plain: list[DataFrame] = []

    def space(table: str, column: str) -> int:
        return spaces.setdefault((table, column), len(spaces))

    def stacks(*keys: tuple[str, str]) -> bool:
        return all(isinstance(tables[t].schema[k].dataType, KEY_TYPES) for t, k in keys)

    def row(number: int, value: Column, role: int) -> Column:
        return F.struct(F.lit(number).alias("space"), value.cast("string").alias("value"), F.lit(role).alias("role"))

    def keys_of(table: str, column: str) -> int:
        number = space(table, column)
        if (table, column) not in in_role_0:
            in_role_0.add((table, column))
            emitted.setdefault(table, []).append(row(number, F.col(column), 0))
        return number

    for table, want in wanted.items():
        for check, columns in (("unique", want.unique), ("duplicates", want.duplicates)):
            for column in columns:
                if not stacks((table, column)):
                    one = check_unique if check == "unique" else check_duplicates
                    plain.append(one(tables[table], column, table))
                    continue
                asked.append((keys_of(table, column), 0 if check == "unique" else -1, check, table, column, None))
        for ref in want.references:
            if not stacks((table, ref.column), (ref.parent, ref.parent_key)):
                plain.append(check_fk(tables[table], ref.column, tables[ref.parent], ref.parent_key, table, ref.parent, ref.check))
                continue
            number = keys_of(ref.parent, ref.parent_key)
            roles[number] = role = roles.get(number, 0) + 1
            value = F.col(ref.column)
            emitted.setdefault(table, []).append(F.when(value.isNotNull(), row(number, value, role)))
            asked.append((number, role, ref.check, table, ref.column, f"parent {ref.parent}" if ref.parent else None))
        for rule in want.rules:
            rules += 1
            broken = row(-rules, F.lit(None), 0)
            emitted.setdefault(table, []).append(F.when(rule.broken, broken))
            asked.append((-rules, 0, rule.check, table, rule.column, None))
    if not asked:
        return union_results(plain) if plain else spark.createDataFrame([], RESULT)

    stacked = reduce(DataFrame.unionByName, [
        tables[t].select(F.explode(F.array_compact(F.array(*found))).alias("r")).select("r.space", "r.value", "r.role")
        for t, found in emitted.items()])
    most = max(roles.values(), default=0)
    counted = stacked.groupBy("space", "value").agg(*[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(most + 1)])
    # Role -1: keys that repeat, the null one among them.
    repeats = F.count_if(F.col("n0") > 1)
    metrics = counted.groupBy("space").agg(
        F.when(F.col("space") < 0, F.sum("n0")).otherwise(F.count_if((F.col("n0") > 1) & F.col("value").isNotNull())).alias("m0"),
        repeats.alias("m_1"), *[F.sum(F.when(F.col("n0") == 0, F.col(f"n{i}"))).alias(f"m{i}") for i in range(1, most + 1)])
    each = F.explode(F.array(*[
        F.struct(F.lit(i).alias("role"), F.col("m_1" if i < 0 else f"m{i}").alias("metric")) for i in range(-1, most + 1)]))
    found = metrics.select("space", each.alias("e")).select("space", "e.role", "e.metric")
    names = spark.createDataFrame(
        asked, "space int, role int, check_name string, table_name string, column_name string, detail string")
    metric = F.coalesce("metric", F.lit(0)).cast("bigint")
    results = F.broadcast(names).join(found, ["space", "role"], "left").select(
        "check_name", "table_name", "column_name", metric.alias("metric"),
        F.when(metric == 0, OK).otherwise(WARNING).alias("status"), "detail")
    return union_results([results, *plain])


def check_loaded(source: DataFrame, target: DataFrame, column: str, now, table: str,
                 hours: int = fixed.FRESHNESS_HOURS) -> DataFrame:
    """Row counts of both sides and the freshness of the target, which is read once."""
    if column not in target.columns:
        return union_results([check_counts(source, target, table), check_freshness(target, column, now, table, hours)])
    none = F.lit(0).cast("bigint")
    never = F.lit(None).cast("timestamp_ntz")
    both = source.agg(F.count("*").alias("s"), none.alias("t"), never.alias("newest")).unionByName(
        target.agg(none.alias("s"), F.count("*").alias("t"), F.max(as_ts(column)).alias("newest"))
    ).agg(F.sum("s").alias("s"), F.sum("t").alias("t"), F.max("newest").alias("newest"))
    return _loaded(both, column, now, table, hours)


def check_observed(source: DataFrame, rows: int, newest: str | None, column: str, now, table: str,
                   hours: int = fixed.FRESHNESS_HOURS) -> DataFrame:
    """check_loaded where the target's row count and newest moment are known from its load."""
    both = source.agg(F.count("*").alias("s")).select(
        "s", F.lit(rows).cast("bigint").alias("t"), F.lit(newest).cast("timestamp_ntz").alias("newest"))
    return _loaded(both, column, now, table, hours)


def _loaded(both: DataFrame, column: str, now, table: str, hours: int) -> DataFrame:
    """Results of one row: s and t rows on either side, and the target's newest moment."""
    age, status, detail = _freshness(F.col("newest"), now, hours)
    counts = F.struct(
        F.lit("row_count").alias("check_name"), F.lit(None).cast("string").alias("column_name"),
        (F.col("s") - F.col("t")).cast("bigint").alias("metric"), F.when(F.col("s") == F.col("t"), OK).otherwise(WARNING).alias("status"),
        F.concat_ws(" -> ", "s", "t").alias("detail"))
    fresh = F.struct(
        F.lit("freshness").alias("check_name"), F.lit(column).alias("column_name"), age.cast("bigint").alias("metric"),
        status.alias("status"), detail.alias("detail"))
    return both.select(F.explode(F.array(counts, fresh)).alias("r")).select(
        "r.check_name", F.lit(table).alias("table_name"), "r.column_name", "r.metric", "r.status", "r.detail")


def check_not_null(df: DataFrame, column: str, table: str) -> DataFrame:
    return check_rules(df, [not_null(column)], table)


def check_accepted(df: DataFrame, column: str, values: list, table: str) -> DataFrame:
    return check_rules(df, [accepted(column, values)], table)


def check_format(df: DataFrame, column: str, table: str,
                 pattern: str = fixed.EMAIL_PATTERN) -> DataFrame:
    return check_rules(df, [email_format(column, pattern)], table)


def check_min(df: DataFrame, column: str, low, table: str) -> DataFrame:
    return check_rules(df, [minimum(column, low)], table)


def quality_report(results: DataFrame) -> DataFrame:
    """Number of results per check family and status."""
    return results.groupBy("check_name", "status").agg(F.count("*").alias("resultados"))
