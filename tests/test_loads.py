import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from abono.operators.history import snapshot_merge
from abono.operators.merge import merge_into_table, merge_statement, merge_upsert, since_watermark
from abono.sinks import versions
from abono.sinks.reports import write_crm_outbox, write_report
from abono.sources.tables import (
    CatalogSource, FileSource, FrameSource, JdbcSource, read_csv, read_tables, schema_name)
from abono.schemas import RAW_SCHEMAS
from tests.conftest import rows, ts

ROW = "id int, v string, at timestamp_ntz"


def test_merge_upsert(frame):
    target = frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01")], ROW)
    updates = frame([(2, "b1", "2024-01-02"), (2, "b2", "2024-01-03"), (3, "c", "2024-01-02")], ROW)
    out = merge_upsert(target, updates, "id", "at")
    assert rows(out, "id", "v") == [(1, "a"), (2, "b2"), (3, "c")]
    assert rows(merge_upsert(out, updates, "id", "at")) == rows(out)
    shuffled = updates.select("at", "v", "id")
    assert merge_upsert(target, shuffled, "id", "at").columns == target.columns
    assert rows(merge_upsert(target.limit(0), updates, ["id"], "at"), "id") == [(2,), (3,)]


def test_watermark(frame):
    df = frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02 00:00:00.000001"), (3, "c", None)], ROW)
    target = df.filter("id = 1")
    assert rows(since_watermark(df, target, "at"), "id") == [(2,)]
    assert rows(since_watermark(df, target, "at", inclusive=True), "id") == [(1,), (2,)]
    assert since_watermark(df, None, "at").count() == 3
    assert since_watermark(df, target.limit(0), "at").count() == 3
    assert rows(since_watermark(df, target, "id"), "id") == [(2,), (3,)]


def test_watermark_reaches_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], ROW).write.parquet(path)
    df = spark.read.parquet(path)
    plan = since_watermark(df, df.filter("id = 1"), "id")._jdf.queryExecution().executedPlan()
    assert "GreaterThan(id,1)" in plan.toString()


def test_versions(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert versions.read_current(spark, path) is None
    first = frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], ROW)
    assert rows(versions.load_replace(first, path)) == rows(first)
    versions.load_append(frame([(3, "c", "2024-01-03")], ROW), path)
    assert versions.current_version(spark, path) == 1
    # The table read is the one replaced: no path is overwritten while being read.
    kept = versions.read_current(spark, path).filter("id > 1")
    assert rows(versions.load_replace(kept, path), "id") == [(2,), (3,)]
    out = versions.load_incremental(
        frame([(2, "late", "2024-01-01"), (3, "c2", "2024-01-04"), (4, "d", "2024-01-05")], ROW),
        path, "id", "at")
    assert rows(out, "id", "v") == [(2, "b"), (3, "c2"), (4, "d")]
    # A version without its success marker does not count, and its number is not reused.
    os.makedirs(f"{path}/v00000009")
    os.makedirs(f"{path}/a00000008")
    assert versions.current_version(spark, path) == 4
    assert rows(versions.read_current(spark, path)) == rows(out)
    versions.load_replace(first, path)
    assert versions.current_version(spark, path) == 10


def test_snapshot_runs_keep_closed_history_in_place(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "s"), "k int, name string, at timestamp_ntz"
    days = [[], [(1, "a", "2024-01-01"), (2, "b", "2024-01-01")], [(1, "a2", "2024-01-02")],
            [(1, "a2", "2024-01-02"), (2, "b2", "2024-01-03")], []]
    whole = None
    for n, day_rows in enumerate(days):
        source, run_ts = frame(day_rows, ddl), f"2024-01-0{n + 1} 12:00:00"
        whole = snapshot_merge(whole, source, "k", "at", run_ts)
        stored = versions.load_snapshot(source, path, "k", "at", run_ts)
        assert rows(stored.select(*whole.columns)) == rows(whole)
    assert stored.count() == 4
    closed = sorted(p.parent.parent.name for p in tmp_path.glob("s/run=*/abierta=0/*.parquet"))
    assert sorted(set(closed)) == ["run=00000003", "run=00000005"]


def test_failed_load_leaves_the_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    versions.load_replace(frame([(1, "a", "2024-01-01")], ROW), path)
    broken = versions.read_current(spark, path).withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(PySparkException):
        versions.load_replace(broken.select("id", F.col("v").cast("string").alias("v"), "at"), path)
    assert rows(versions.read_current(spark, path), "id", "v") == [(1, "a")]


def test_load_mode(spark, frame, tmp_path):
    one = frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], ROW)
    two = frame([(2, "b2", "2024-01-03")], ROW)
    for incremental, full, want in ((True, False, [(1, "a"), (2, "b2")]), (True, True, [(2, "b2")]),
                                    (False, False, [(2, "b2")])):
        path = str(tmp_path / f"t{incremental}{full}")
        versions.load_table(one, path, "id", incremental, cursor="at")
        out = versions.load_table(two, path, "id", incremental, full, cursor="at")
        assert rows(out, "id", "v") == want


def test_fact_rfm_write_touches_only_its_dates(spark, frame, tmp_path):
    path = str(tmp_path / "fact")
    ddl = "id_dim_cuenta string, x int, id_dim_fecha_rfm date"
    versions.write_fact_rfm(frame([("a", 1, "2024-01-01"), ("b", 2, "2024-01-01")], ddl), path)
    other = tmp_path / "fact" / "id_dim_fecha_rfm=2024-01-01"
    before = sorted(os.listdir(other))
    versions.write_fact_rfm(frame([("a", 5, "2024-07-01")], ddl), path)
    assert sorted(os.listdir(other)) == before
    out = versions.write_fact_rfm(frame([("a", 9, "2024-01-01"), ("c", 3, "2024-01-01")], ddl), path)
    assert [r[:2] + (str(r[2]),) for r in rows(out)] == [
        ("a", 5, "2024-07-01"), ("a", 9, "2024-01-01"), ("b", 2, "2024-01-01"),
        ("c", 3, "2024-01-01")]


def test_outbox_and_empty_report(spark, frame, tmp_path):
    payloads = frame([("h1", "{}"), ("h2", "{}")], "company_id string, payload string")
    write_crm_outbox(payloads, str(tmp_path / "out"))
    assert rows(spark.read.json(str(tmp_path / "out"))) == rows(payloads)
    assert not write_report(payloads.limit(0), str(tmp_path), "2024-01-01")


def test_sources(spark, frame, tmp_path):
    accounts = frame([(1, "n", "e", "2024-01-01", "2024-01-02")], RAW_SCHEMAS["accounts"])
    accounts.write.parquet(str(tmp_path / "accounts"))
    found = FileSource(str(tmp_path), schemas=RAW_SCHEMAS).table(spark, "accounts")
    assert found.schema == accounts.schema and rows(found) == rows(accounts)
    with pytest.warns(UserWarning, match="nothing_like_it"):
        some = read_tables(spark, FrameSource({"accounts": accounts}), ["accounts", "nothing_like_it"])
    assert list(some) == ["accounts"]
    (tmp_path / "f.csv").write_text("id,at\n1,2024-01-01 00:00:00\n2,\n")
    assert rows(read_csv(spark, str(tmp_path / "f.csv"), "id int, at timestamp_ntz")) == [
        (1, ts("2024-01-01")), (2, None)]


def test_catalog_source(spark, frame):
    assert schema_name("raw", "dev") == "raw_dev" and schema_name(None, "dev") == "main_dev"
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_dev")
    frame([(1, "a", "2024-01-01")], ROW).write.mode("overwrite").saveAsTable("raw_dev.things")
    assert CatalogSource("raw", "dev").table(spark, "things").count() == 1
    updates = frame([(1, "b", "2024-01-02")], ROW)
    with pytest.raises(PySparkException):  # plain Parquet tables have no row-level writes
        merge_into_table(updates, "raw_dev.things", "id")
    spark.sql("DROP TABLE raw_dev.things")


def test_jdbc_options_split_on_the_key():
    source = JdbcSource("jdbc:postgresql://host/db", {"user": "u"}, partitions=16)
    options = source.options("accounts", 1, 900)
    assert options["partitionColumn"] == "account_id" and options["numPartitions"] == "16"
    assert (options["lowerBound"], options["upperBound"], options["user"]) == ("1", "900", "u")
    assert "partitionColumn" not in source.options("accounts")


def test_jdbc_ranges_of_equal_row_counts(spark, frame):
    """The texts only: cut points and predicates run here over a view, not over JDBC."""
    source = JdbcSource("jdbc:x", partitions=4, keys={"cuentas_v": "k"}, even=True)
    keys = [*range(100), *[10**9 + i for i in range(300)], 5, 5, None, None]
    frame([(k,) for k in keys], "k bigint").createOrReplaceTempView("cuentas_v")
    cuts = [r.cut for r in spark.sql(f"SELECT cut FROM {source.cuts_query('cuentas_v')}").collect()]
    sizes = [spark.table("cuentas_v").where(p).count() for p in source.ranges("cuentas_v", cuts)]
    assert len(sizes) == 4 and sum(sizes) == len(keys) and max(sizes) < 110
    assert source.ranges("cuentas_v", []) == ["1 = 1"] and len(source.ranges("cuentas_v", [7, 7])) == 2
    assert source.ranges("cuentas_v", ["b", "a"])[1] == "k >= 'a' AND k < 'b'"


def test_numbers_beyond_eight_digits_and_release(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(1,)], "k int").write.parquet(f"{path}/v99999999")
    assert rows(versions.load_replace(frame([(2,)], "k int"), path)) == [(2,)]
    assert versions.current_version(spark, path) == 100_000_000
    assert versions.drop_old_versions(spark, path) == 1
    assert rows(versions.read_current(spark, path)) == [(2,)]
    assert versions.drop_old_versions(spark, str(tmp_path / "none")) == 0


def test_upsert_keeps_one_row_per_key_of_any_batch(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, at int, v string"
    batch = frame([(1, 1, "a"), (1, 3, "b"), (1, 3, "c"), (2, None, "z")], ddl)
    assert rows(versions.load_upsert(batch, path, "k", "at")) == [(1, 3, "c"), (2, None, "z")]
    assert rows(versions.load_upsert(frame([(1, 2, "x"), (1, 2, "y")], ddl), path, "k")) == [
        (1, 2, "y"), (2, None, "z")]


def files(path, pattern):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.glob(pattern)}


def test_upsert_rewrites_only_touched_buckets(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, at int, v string"
    first = frame([(k, 1, "a") for k in range(100)], ddl)
    versions.load_upsert(first, path, "k", "at", buckets=8)
    before = files(tmp_path, "t/u*/cubeta=*/*.parquet")
    assert len(before) == 8
    out = versions.load_upsert(frame([(7, 2, "b"), (7, 3, "c")], ddl), path, "k", "at")
    after = files(tmp_path, "t/u*/cubeta=*/*.parquet")
    assert before.items() <= after.items() and len(after) == 9
    assert rows(out, "k", "v") == sorted([(k, "c" if k == 7 else "a") for k in range(100)], key=lambda r: [(v is None, str(v)) for v in r])
    # Nothing new, nothing written.
    assert versions.load_incremental(first, path, "k", "at").count() == 100
    assert files(tmp_path, "t/*/*/*.parquet") == after
    # Appended rows move to their buckets with the next upsert; a bucket of neither keeps its file.
    versions.load_append(frame([(200, 4, "x"), (201, 4, "y")], ddl), path)
    out = versions.load_upsert(frame([(200, 5, "z"), (300, 5, "w")], ddl), path, "k", "at")
    assert out.count() == 103 and rows(out.filter("k >= 200"), "k", "v") == [(200, "z"), (201, "y"), (300, "w")]
    number = versions.current_version(spark, path)
    manifest = versions.b.read_manifest(spark, path, f"m{number:08d}")
    kept = {f for f in manifest.folders.values() if f.startswith("u00000001/")}
    assert 8 - 3 - 1 <= len(kept) < 8 and set(manifest.folders) == set(range(8))
    # What the manifest doesn't name can go; the table stays.
    assert versions.drop_old_versions(spark, path) > 0
    assert rows(versions.read_current(spark, path)) == rows(out)
    assert len(list(tmp_path.glob("t/u*/cubeta=*"))) == 8


def test_upsert_after_replace_and_with_another_layout(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, j int, v string"
    versions.load_replace(frame([(1, 1, "a"), (2, 2, "b"), (None, 3, "n")], ddl), path)
    out = versions.load_upsert(frame([(2, 2, "c"), (3, 3, "d")], ddl), path, "k", buckets=4)
    assert rows(out, "k", "v") == [(1, "a"), (2, "c"), (3, "d"), (None, "n")]
    out = versions.load_upsert(frame([(2, 9, "e")], ddl), path, ["k", "j"], buckets=3)
    assert rows(out, "k", "j", "v") == [(1, 1, "a"), (2, 2, "c"), (2, 9, "e"), (3, 3, "d"), (None, 3, "n")]
    out = versions.load_upsert(frame([], ddl), path, ["k", "j"])
    assert out.count() == 5
    # A table may begin empty.
    empty = str(tmp_path / "e")
    assert versions.load_upsert(frame([], ddl), empty, "k").count() == 0
    assert versions.load_upsert(frame([(1, 1, "a")], ddl), empty, "k").count() == 1


def test_failed_upsert_leaves_the_table(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "k int, at int, v string"
    versions.load_upsert(frame([(k, 1, "a") for k in range(9)], ddl), path, "k", "at")
    # Buckets without a manifest, as a load that stopped between the two leaves them.
    frame([(1, "lost")], "k int, v string").write.parquet(f"{path}/u00000009/cubeta=1")
    (tmp_path / "t" / "m00000009").mkdir()
    assert {r[1] for r in rows(versions.read_current(spark, path), "k", "v")} == {"a"}
    assert versions.load_upsert(frame([(1, 2, "b")], ddl), path, "k", "at").filter("v = 'b'").count() == 1
    assert versions.current_version(spark, path) == 10


def test_snapshot_run_with_one_change_writes_one_bucket(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "s"), "k int, name string, at timestamp_ntz"
    base = [(k, "a", "2024-01-01") for k in range(100)]
    versions.load_snapshot(frame(base, ddl), path, "k", "at", "2024-01-01 12:00:00", buckets=8)
    before = files(tmp_path, "s/run=*/abierta=1/*/*.parquet")
    assert len(before) == 8
    changed = [(k, "b", "2024-01-02") if k == 7 else (k, n, a) for k, n, a in base]
    out = versions.load_snapshot(frame(changed, ddl), path, "k", "at", "2024-01-02 12:00:00")
    after = files(tmp_path, "s/run=*/abierta=1/*/*.parquet")
    assert before.items() <= after.items() and len(after) == 9
    assert len(files(tmp_path, "s/run=*/abierta=0/*.parquet")) >= 1
    assert out.count() == 101 and out.filter("k = 7").count() == 2
    # The same source again changes nothing and writes nothing.
    whole = files(tmp_path, "s/**/*")
    assert versions.load_snapshot(frame(changed, ddl), path, "k", "at", "2024-01-03").count() == 101
    assert files(tmp_path, "s/**/*") == whole
    # Deleting every key of a bucket leaves it empty, and other buckets alone.
    gone = versions.load_snapshot(frame([], ddl), path, "k", "at", "2024-01-04 00:00:00")
    assert gone.count() == 101 and gone.filter("dbt_valid_to IS NULL").count() == 0
    again = versions.load_snapshot(frame(base[:1], ddl), path, "k", "at", "2024-01-05")
    assert again.filter("dbt_valid_to IS NULL").count() == 1


def test_merge_statement_names_both_sides(spark):
    """No catalog with row-level writes is at hand; the statement is only parsed."""
    text = merge_statement("lake.raw_dev.accounts", "v", ["account_id", "day"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan and "lake, raw_dev, accounts" in plan
    assert "('destino.account_id = 'cambios.account_id) AND ('destino.day = 'cambios.day)" in plan


def test_credentials_of_the_command_line(monkeypatch):
    from abono import cli
    monkeypatch.setenv("DB_PASSWORD", "secret=1")
    args = cli.parser().parse_args(["load", "--source", "jdbc:x", "--lake", "l", "--partitions", "9", "--buckets", "5", "--raw-catalog", "ice",
                                    "--jdbc-option", "user=u", "--jdbc-option", "driver=a.B", "--jdbc-option", "password=env:DB_PASSWORD"])
    cfg = cli.config(args)
    options = cfg.source.options("accounts", 1, 9)
    assert (options["user"], options["password"], options["driver"], options["numPartitions"]) == ("u", "secret=1", "a.B", "9")
    assert cfg.buckets == 5 and cfg.raw_table("accounts") == "ice.raw_local.accounts"
    with pytest.raises(ValueError):
        cli.jdbc_options(["user"])


def test_facts_are_observed_while_loading(spark, frame, tmp_path):
    """Counts and newest moments of every kind of load equal those of the rows, which are not read."""
    def holds(path, known=True):
        got = versions.loaded_facts(spark, path, "at")
        now = versions.read_current(spark, path).agg(F.count("*"), F.max("at").cast("string")).first()
        assert (got is not None) == known and (not known or (got.rows, got.newest) == tuple(now))

    merged, plain = str(tmp_path / "merged"), str(tmp_path / "plain")
    assert versions.loaded_facts(spark, merged, "at") is None
    many = frame([(i, "a", f"2024-01-01 00:00:{i % 60:02d}.25") for i in range(100)] + [(None, "n", None)], ROW)
    versions.load_table(many, merged, "id", True, cursor="at", buckets=8)
    holds(merged)
    versions.load_table(frame([(7, "b", "2024-02-01"), (500, "c", "2024-01-05")], ROW), merged, "id", True, cursor="at")
    holds(merged)
    assert versions.loaded_facts(spark, merged, "at").rows == 102
    versions.load_append(frame([(501, "d", "2024-03-01")], ROW), merged, "at")
    holds(merged)
    versions.load_upsert(frame([(502, "e", "2024-01-01")], ROW), merged, "id", "at")
    holds(merged)
    versions.load_table(many.limit(3), merged, "id", True, True, "at")
    holds(merged)
    assert versions.loaded_facts(spark, merged, "id") is None
    for df in (many, many.limit(0), many.filter("id is null")):
        versions.load_table(df, plain, "id", False, cursor="at")
        holds(plain)
    versions.load_append(many, plain)
    holds(plain, known=False)
    assert versions.loaded_facts(spark, plain, "at") is None


def test_a_load_without_facts_is_read(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame([(1, "a", "2024-01-01"), (2, "b", "2024-01-02")], ROW)
    versions.load_replace(df, path, "at")
    os.remove(f"{path}/v00000001/_facts")
    assert versions.loaded_facts(spark, path, "at") is None
    versions.load_buckets(df, path, "id", "at", buckets=400)
    assert versions.loaded_facts(spark, path, "at") is None
    assert versions.read_current(spark, path).count() == 2
