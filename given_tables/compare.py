"""Run registered queries and their SQL side by side: python -m given_tables.compare [sf_dir] [name ...]"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


def session(cpus: int = 8) -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cpus}]")
             .config("spark.sql.shuffle.partitions", str(cpus))
             .config("spark.driver.memory", "12g")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return ("n", round(float(v), 6))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, float):
        return ("n", None if math.isnan(v) else round(v, 6))
    if isinstance(v, int):
        return ("n", round(float(v), 6))
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("d", v.isoformat())
    return ("s", v)


def rows(columns: list[str], data) -> list:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in data), key=repr)


KINDS = {"HUGEINT": "int128", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DOUBLE": "double"}


def compare(spark, con, name, build, sql, sf_dir) -> str | None:
    df = build(spark, sf_dir)
    rel = con.sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    types = dict(df.dtypes)
    for c, t in zip(rel.columns, rel.types):
        want = KINDS.get(str(t), str(t).lower())
        if types[c] != want:
            return f"type of {c}: {types[c]} != {want}"
    got, want = rows(df.columns, df.collect()), rows(rel.columns, rel.fetchall())
    if got != want:
        extra = [r for r in got if r not in want][:2] if len(got) < 3000 else got[:1]
        lack = [r for r in want if r not in got][:2] if len(got) < 3000 else want[:1]
        return f"{len(got)} vs {len(want)} rows; extra {extra}; missing {lack}"
    return None


def main() -> int:
    from given_tables.queries import ORACLES, QUERIES
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con = session(), duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as e:  # reported per query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s"
              f" {problem or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
