from pyspark.sql import functions as F
import datetime as dt

from abono.operators import checks
from abono.operators import checks as c
from abono.plans import quality
from abono.schemas import RAW_KEYS, RAW_SCHEMAS
from abono.sources.tables import FrameSource
from tests.conftest import rows


def verdict(df):
    r = df.first()
    return r["metric"], r["status"]


def test_counts_duplicates_orphans(spark, frame):
    a = frame([(1, 1), (1, 2), (2, 2), (None, 3), (None, 3)], "id int, fk int")
    assert verdict(c.check_counts(a, a.limit(2), "t")) == (3, "WARNING")
    assert verdict(c.check_counts(a.limit(0), a.limit(0), "t")) == (0, "OK")
    assert verdict(c.check_duplicates(a, "id", "t")) == (2, "WARNING")  # null key counts as a key
    assert verdict(c.check_unique(a, "id", "t")) == (1, "WARNING")
    assert verdict(c.check_duplicates(a, None, "t")) == (None, "SKIP")
    assert verdict(c.check_duplicates(a, ["id", "fk"], "t")) == (1, "WARNING")
    parent = frame([(2,), (3,)], "id int")
    assert verdict(c.check_fk(a, "id", parent, "id", "t")) == (2, "WARNING")
    assert verdict(c.check_fk(a, "id", parent.limit(0), "id", "t")) == (3, "WARNING")
    assert verdict(c.check_fk(a.limit(0), "id", parent, "id", "t")) == (0, "OK")
    assert rows(c.orphans(a, "id", parent, "id")) == [(1, 1), (1, 2)]


def test_freshness(frame):
    now = "2024-01-31 00:00:00"
    base = dt.datetime.fromisoformat(now)

    def at(*hours):
        df = frame([(None if h is None else str(base - dt.timedelta(hours=h)),) for h in hours],
                   "updated_at timestamp_ntz")
        r = c.check_freshness(df, "updated_at", now, "t").first()
        return r["status"], r["detail"].split(":")[0]

    assert at(47, 500, None) == ("OK", "fresh")
    assert at(0) == ("OK", "fresh")
    assert at(48) == ("WARNING", "stale")  # exactly at the limit
    assert at(-1, 3) == ("WARNING", "future")
    assert at(None) == ("WARNING", "no timestamps")
    assert verdict(c.check_freshness(frame([(1,)], "x int"), "updated_at", now, "t"))[1] == "SKIP"


def test_row_rules_in_one_pass(frame):
    df = frame([(None, "quiz", "a@b.co", 1), (1, None, None, 0), (2, "zz", "bad", -1)],
               "id int, kind string, mail string, n int")
    out = c.check_rules(df, [c.not_null("id"), c.accepted("kind", ["quiz"]),
                             c.email_format("mail"), c.minimum("n", 0)], "t")
    assert rows(out, "check_name", "metric") == [
        ("accepted_values", 1), ("email_format", 1), ("minimum", 1), ("not_null", 1)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
    assert c.check_rules(df.limit(0), [c.not_null("id")], "t").first()["status"] == "OK"


def test_declared_rules_cover_everything():
    counts = dict(not_null=0, unique=0, relationships=0, accepted=0)
    for layer in (quality.RAW_CHECKS, quality.STAGING_CHECKS, quality.MART_CHECKS):
        for want in layer.values():
            counts["not_null"] += bool(want.key) + len(want.required)
            counts["unique"] += bool(want.key)
            counts["relationships"] += len(want.references)
            counts["accepted"] += len(want.accepted)
    assert counts == dict(not_null=49, unique=18, relationships=17, accepted=5)


def test_full_run_reports_missing_tables_and_goes_on(spark, frame):
    accounts = frame([(1, "2024-01-30"), (2, "2024-01-30")],
                     "account_id int, updated_at timestamp_ntz")
    contents = frame([(1, 1, "2024-01-01"), (2, 9, "2024-01-01"), (2, None, "2024-01-01")],
                     "content_id int, account_id int, updated_at timestamp_ntz")
    source = FrameSource({"accounts": accounts, "contents": contents})
    target = FrameSource({"accounts": accounts.limit(1), "contents": contents})
    out = quality.run_checks(spark, source, target, "2024-01-31",
                             ["accounts", "contents", "subscriptions"])
    got = {(r["check_name"], r["table_name"]): (r["metric"], r["status"]) for r in out.collect()}
    assert got["row_count", "accounts"] == (1, "WARNING")
    assert got["foreign_key", "accounts"] == (None, "SKIP")
    assert got["duplicates", "contents"] == (1, "WARNING")
    assert got["foreign_key", "contents"] == (1, "WARNING")
    assert got["freshness", "accounts"][1] == "OK" and got["freshness", "contents"][1] == "WARNING"
    assert got["row_count", "subscriptions"] == (0, "ERROR")
    assert rows(c.quality_report(out).filter("check_name = 'row_count'"), "status", "resultados") == [
        ("ERROR", 1), ("OK", 1), ("WARNING", 1)]
    assert set(RAW_KEYS) == set(quality.RAW_CHECKS)


def test_a_check_that_fails_while_running_is_an_error_row(spark, frame):
    good = frame([(1, "2024-01-01 00:00:00")], "account_id int, updated_at timestamp_ntz")
    bad = good.withColumn("account_id", F.expr("if(account_id > 0, cast(raise_error('broken\nfile') as int), 1)"))

    class Source:
        def table(self, _, name):
            return bad if name == "contents" else good

    keys = {"accounts": "account_id", "contents": "account_id"}
    found = quality.run_checks(spark, Source(), Source(), "2024-01-01 10:00:00", list(keys), keys, {})
    got = {(r.table_name, r.check_name): r for r in found.collect()}
    assert got["accounts", "duplicates"].status == "OK" and got["contents", "duplicates"].status == "ERROR"
    assert "file" in got["contents", "duplicates"].detail and got["contents", "freshness"].status == "OK"


def test_fused_checks_equal_the_single_ones(spark, frame):
    parents = frame([(1, "a"), (2, "b"), (2, "b"), (None, "n"), (None, "m"), (3, None)], "id int, code string")
    children = frame([(1, 1, "a", 5), (2, 9, "zz", 6), (3, 9, None, 6), (4, None, "b", None), (4, 2, "b", 7)],
                     "k bigint, parent bigint, code string, v int")
    other = frame([(1.0, 1.0), (1.0, 2.0)], "d double, e double")
    tables = {"parents": parents, "children": children, "other": other}
    rules = [checks.not_null("v"), checks.accepted("v", [5, 6]), checks.minimum("v", 7)]
    wanted = {
        "parents": checks.Wanted(unique=["id"], duplicates=["id"]),
        "children": checks.Wanted(rules, ["k"], [], [checks.Reference("parent", "parents", "id"), checks.Reference("code", "parents", "code", "relationships")]),
        "other": checks.Wanted(unique=["d"], references=[checks.Reference("e", "other", "d")])}
    single = checks.union_results([
        checks.check_unique(parents, "id", "parents"), checks.check_duplicates(parents, "id", "parents"),
        checks.check_rules(children, rules, "children"), checks.check_unique(children, "k", "children"),
        checks.check_fk(children, "parent", parents, "id", "children", "parents"),
        checks.check_fk(children, "code", parents, "code", "children", "parents", "relationships"),
        checks.check_unique(other, "d", "other"), checks.check_fk(other, "e", other, "d", "other", "other")])
    fused = checks.fused(tables, wanted)
    assert rows(fused) == rows(single.select(*fused.columns))
    metrics = {(r.check_name, r.table_name, r.column_name): r.metric for r in fused.collect()}
    assert metrics["unique", "parents", "id"] == 1 and metrics["duplicates", "parents", "id"] == 2
    assert metrics["foreign_key", "children", "parent"] == 2 and metrics["relationships", "children", "code"] == 1
    none = checks.fused({n: df.limit(0) for n, df in tables.items()}, wanted)
    assert {r.metric for r in none.collect()} == {0} and none.count() == fused.count()


def test_declared_checks_scan_each_table_once(spark, frame, tmp_path):
    frames = {}
    for name in quality.RAW_CHECKS:
        frame([], RAW_SCHEMAS[name]).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    plan = quality.declared_checks(frames, quality.RAW_CHECKS)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == len(frames) and "SortMergeJoin" not in plan
