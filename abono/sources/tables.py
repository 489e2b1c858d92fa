"""Where tables come from: files, a JDBC database, or a catalog."""

from __future__ import annotations

import decimal
import warnings
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from abono import fixed
from abono.schemas import RAW_KEYS


@dataclass(frozen=True)
class FileSource:
    """One file or folder per table under a root."""

    root: str
    fmt: str = "parquet"
    suffix: str = ""
    schemas: dict[str, StructType | str] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.read.format(self.fmt)
        if name in self.schemas:
            reader = reader.schema(self.schemas[name])
        return reader.load(f"{self.root}/{name}{self.suffix}")


@dataclass(frozen=True)
class FrameSource:
    """Tables that already are DataFrames."""

    frames: dict[str, DataFrame]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.frames:
            raise KeyError(f"no table {name}")
        return self.frames[name]


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a transactional database, read in parallel key ranges by the executors. Ranges
    are of equal width between the least and the greatest key, or, with `even`, of equal row
    counts, by cut points that the database finds. Either is asked for once per table."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    partitions: int = 64
    keys: dict[str, str] = field(default_factory=lambda: dict(RAW_KEYS))
    even: bool = False
    asked: dict[str, list] = field(default_factory=dict, compare=False, repr=False)

    def options(self, name: str, low=None, high=None) -> dict[str, str]:
        found = {"url": self.url, "dbtable": name, "fetchsize": "10000", **self.properties}
        if low is not None and high is not None:
            found |= {"partitionColumn": self.keys[name], "lowerBound": str(low),
                      "upperBound": str(high), "numPartitions": str(self.partitions)}
        return found

    def cuts_query(self, name: str) -> str:
        """The least key of each share of the rows but the first, as a table to read."""
        key = self.keys[name]
        shares = f"SELECT {key} AS k, ntile({self.partitions}) OVER (ORDER BY {key}) AS share FROM {name} WHERE {key} IS NOT NULL"
        return f"(SELECT min(k) AS cut FROM ({shares}) s WHERE share > 1 GROUP BY share) b"

    def ranges(self, name: str, cuts: list) -> list[str]:
        """Predicates that every row meets exactly one of; null keys go with the lowest."""
        key, cuts = self.keys[name], sorted(set(cuts))
        if not cuts:
            return ["1 = 1"]
        shown = [f"'{c}'" if not isinstance(c, (int, decimal.Decimal)) else str(c) for c in cuts]
        inner = [f"{key} >= {low} AND {key} < {high}" for low, high in zip(shown, shown[1:])]
        return [f"{key} < {shown[0]} OR {key} IS NULL", *inner, f"{key} >= {shown[-1]}"]

    def _ask(self, spark: SparkSession, name: str, query: str) -> list:
        if name not in self.asked:
            self.asked[name] = [tuple(r) for r in spark.read.format("jdbc").options(**self.options(query)).load().collect()]
        return self.asked[name]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        if name not in self.keys:
            return spark.read.format("jdbc").options(**self.options(name)).load()
        key = self.keys[name]
        if self.even:
            cuts = [cut for (cut,) in self._ask(spark, name, self.cuts_query(name))]
            properties = {"fetchsize": "10000", **self.properties}
            return spark.read.jdbc(self.url, name, predicates=self.ranges(name, cuts), properties=properties)
        bounds = f"(SELECT min({key}) AS low, max({key}) AS high FROM {name}) b"
        (low, high), = self._ask(spark, name, bounds)
        return spark.read.format("jdbc").options(**self.options(name, low, high)).load()


@dataclass(frozen=True)
class CatalogSource:
    """Tables of one layer and environment in the session catalog."""

    layer: str
    env: str

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return table(spark, self.layer, self.env, name)


def schema_name(layer: str | None, env: str, default: str = "main") -> str:
    """Schema of a layer in an environment: `<layer>_<env>`, or the default's."""
    return f"{layer or default}_{env}"


def table(spark: SparkSession, layer: str | None, env: str, name: str) -> DataFrame:
    return spark.table(f"{schema_name(layer, env)}.{name}")


def read_tables(spark: SparkSession, source, tables: list[str] | None = None) -> dict[str, DataFrame]:
    """The named raw tables, all of them by default; unknown names are warned of and skipped."""
    found = {}
    for name in tables or list(fixed.RAW_TABLES):
        if name not in fixed.RAW_TABLES:
            warnings.warn(f"table {name} is not one of the raw tables; skipped", stacklevel=2)
            continue
        found[name] = source.table(spark, name)
    return found


# Columns read for the enterprise report.
REPORT_INPUTS = {
    "accounts": ["account_id", "account_name", "email", "created_at", "updated_at"],
    "subscriptions": ["subscription_id", "subscription_name", "max_contents_per_month",
                      "created_at", "updated_at"],
    "accounts_subscription": ["account_subscription_id", "account_id", "subscription_id",
                              "start_date", "end_date"],
}


def extract_report_inputs(spark: SparkSession, source) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Accounts, plans and periods, projected in the scan."""
    accounts, plans, periods = (
        source.table(spark, name).select(*columns) for name, columns in REPORT_INPUTS.items())
    return accounts, plans, periods


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    """Inline rows, for tests and small fixed tables; dates may be given as ISO text."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    text = spark.createDataFrame(
        [tuple(None if v is None else str(v) for v in row) for row in rows],
        ", ".join(f"`{f.name}` string" for f in schema))
    return text.select(*[F.col(f.name).cast(f.dataType) for f in schema])
