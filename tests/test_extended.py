"""Changes, distinct counts and joins on time against plain versions."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes, distinct, monitoring, temporal
from ledgerline.plans import fixtures
from ledgerline.sources import financials, layers
from ledgerline.streaming import health

ROOT = "/root/testdata/sf0.001"
DAY = dt.date(2020, 1, 1)


def test_signed_difference_is_except_all_both_ways(spark):
    rng = random.Random(1)
    rows = [[(rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None])) for _ in range(40)] for _ in range(2)]
    old, new = (spark.createDataFrame(r, "k int, v string") for r in rows)
    found = Counter({(r.k, r.v): r.sign for r in changes.signed_difference(old, new).collect()})
    came, gone = (Counter(map(tuple, x.collect())) for x in (new.exceptAll(old), old.exceptAll(new)))
    assert +found == came and -found == gone


def test_kinds_of_change(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (3, "c")], "k int, v string")
    found = changes.kinds_of_change(changes.signed_difference(old, new), ["k"]).collect()
    assert sorted(map(tuple, found)) == [(2, "changed"), (3, "deleted"), (4, "inserted")]
    assert changes.signed_difference(old, old).count() == 0


def test_upkeep_equals_a_full_recompute(spark):
    old, new = fixtures.order_snapshots(spark, ROOT)
    totals = financials.order_totals(spark, ROOT)
    stored = layers.materialize(financials.customer_months(totals, old))
    changed = layers.materialize(changes.signed_difference(old, new))
    now, _ = financials.updated_financials(spark, ROOT, stored, changed, "nation")
    full = financials.customer_months(totals, new)
    assert changes.signed_difference(full.select(*now.columns), now).count() == 0
    # back again, and no change at all
    back = layers.materialize(changes.signed_difference(new, old))
    again, _ = financials.updated_financials(spark, ROOT, layers.materialize(now), back, "nation")
    assert changes.signed_difference(stored, again.select(*stored.columns)).count() == 0


def test_only_lines_of_changed_orders_are_summed(spark):
    only = spark.createDataFrame([(1,), (1,), (2,)], "o_orderkey long")
    totals = financials.order_totals(spark, ROOT, only)
    lines = spark.read.parquet(f"{ROOT}/lineitem.parquet").where("l_orderkey IN (1, 2)").count()
    assert (totals.agg(F.sum("n_lines")).first()[0] or 0) == lines
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_merged_distinct_counts(spark):
    rng = random.Random(2)
    rows = [(f"c{rng.randint(0, 1)}", dt.date(2020, rng.randint(1, 12), 1), rng.choice([None, 0, -5, 7, 40_000, 10**9, rng.randint(1, 90_000)])) for _ in range(3000)]
    months = spark.createDataFrame(rows, "company string, date date, o_custkey long")
    last = spark.createDataFrame([(dt.date(2020, 12, 1),)], "d date")
    keys = ["company", "date"]
    exact = distinct.merged_count(distinct.into_windows(distinct.bitmaps(months, keys, "o_custkey"), 3, last), keys, "n")
    wanted = {}
    for company, date, value in rows:
        for k in range(3):
            if value is not None and date.month + k <= 12:
                wanted.setdefault((company, dt.date(2020, date.month + k, 1)), set()).add(value)
    assert {(r.company, r.date): r.n for r in exact.collect()} == {k: len(v) for k, v in wanted.items()}
    guessed = distinct.merged_estimate(distinct.into_windows(distinct.sketches(months, keys, "o_custkey"), 3, last), keys, "n")
    for r in guessed.collect():
        assert abs(r.n / len(wanted[r.company, r.date]) - 1) <= distinct.error_bound()
    assert "count(distinct" not in exact._jdf.queryExecution().optimizedPlan().toString().lower()


def stamp(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("tolerance", [None, 500])
@pytest.mark.parametrize("seconds", [100, 1000, 10**7])
def test_asof_join_equals_a_loop(spark, tolerance, seconds):
    rng = random.Random(seconds)
    left = [(k, rng.choice(["x", "x", "y", "z"]), stamp(rng.randint(0, 3000))) for k in range(150)] + [(900, "x", None), (901, "nobody", stamp(5))]
    right = [(k, rng.choice(["x", "x", "y"]), stamp(rng.randint(300, 3000)), k * 1.5) for k in range(60)] + [(61, "x", stamp(700), 1.0), (62, "x", stamp(700), 2.0), (63, "x", None, 3.0)]
    found = temporal.asof_join(
        spark.createDataFrame(left, "id long, key string, ts timestamp"),
        spark.createDataFrame(right, "event long, key string, ts timestamp, rate double"),
        "ts", ["key"], "event", tolerance, seconds,
    ).select("id", "right_event", "right_rate").collect()
    wanted = []
    for id_, key, ts in left:
        known = [(t, e, v) for e, k, t, v in right if ts and t and k == key and t <= ts]
        t, e, v = max(known, default=(None, None, None))
        if t is not None and tolerance is not None and (ts - t).total_seconds() > tolerance:
            e = v = None
        wanted.append((id_, e, v))
    assert sorted(map(tuple, found)) == wanted


@pytest.mark.parametrize("unit", [1, 3, 32])
def test_interval_join_equals_the_theta_join(spark, unit):
    rng = random.Random(unit)

    def intervals(n):
        out = []
        for k in range(n):
            start = DAY + dt.timedelta(days=rng.randint(-400, 400))
            out.append((k, start, start + dt.timedelta(days=rng.choice([0, 0, 1, 5, 31, 90, 365, 4000, -1]))))
        return out + [(n, None, DAY), (n + 1, DAY, None)]

    left, right = intervals(70), intervals(60)
    a, b = (spark.createDataFrame(x, "id int, start date, stop date") for x in (left, right))
    joined = temporal.interval_join(a, b, "start", "stop", unit)
    wanted = sorted(
        (i, j) for i, s, e in left for j, t, u in right
        if None not in (s, e, t, u) and s <= e and t <= u and s <= u and t <= e
    )
    assert sorted((r.id, r.right_id) for r in joined.collect()) == wanted
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_long_interval_has_few_rows(spark):
    long = spark.createDataFrame([(dt.date(1900, 1, 1), dt.date(2099, 12, 31), 0)], "start date, stop date, id int")
    levelled = temporal._levelled(long, "start", "stop", 1)
    assert temporal._placed(levelled, "start", "stop", 1).count() <= 2


def test_hierarchy_totals_scan_the_lines_once(spark):
    sets, columns = [(), ("region",), ("region", "year")], ("region", "nation", "segment", "year", "quarter", "month")
    totals = financials.hierarchy_totals(spark, ROOT, sets, columns)
    assert totals._jdf.queryExecution().executedPlan().toString().count("lineitem.parquet") == 1
    rows = totals.collect()
    whole = next(r for r in rows if r.level == 63)
    assert whole.n_orders == sum(r.n_orders for r in rows if r.level == 31) == sum(r.n_orders for r in rows if r.level == 27)


def plain_sessions(rows, gap):
    """(user, time, stage) -> (user, start, stop, n, stages), by one loop in order of time."""
    out = []
    for user, at, stage in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0], r[1], r[2] or "")):
        if not out or out[-1][0] != user or (at - out[-1][2]).total_seconds() > gap:
            out.append([user, at, at, 0, []])
        out[-1][2], out[-1][3] = at, out[-1][3] + 1
        if stage is not None and stage not in out[-1][4]:
            out[-1][4].append(stage)
    return sorted((str(u), a, b, n, " > ".join(x)) for u, a, b, n, x in out)


def test_sessions_equal_a_loop(spark):
    rng, noon = random.Random(5), dt.datetime(2024, 1, 1, 12)
    # one user has most rows, without a gap for days; others are sparse; ranges are cut at midnight
    rows = [(1, noon + dt.timedelta(seconds=rng.randint(0, 4 * 86400)), rng.choice(["a", "b", None])) for _ in range(3000)]
    rows += [(rng.choice([2, 3, None]), noon + dt.timedelta(minutes=15 * rng.randint(0, 3000)), rng.choice("abc")) for _ in range(300)]
    rows += [(2, None, "a"), (4, noon, "b"), (4, noon, "a"), (4, noon + dt.timedelta(hours=1), "c")]
    table = spark.createDataFrame(rows, "user int, _t timestamp, stage string")
    for gap in (3600, 7200):
        found = temporal.sessions(table, ["user"], "_t", "stage", gap).collect()
        assert sorted((str(r.user), r.session_start, r.session_end, r.n_rows, r.stages) for r in found) == plain_sessions(rows, gap)
        assert all(r.duration == (r.session_end - r.session_start).total_seconds() for r in found)
    assert temporal.sessions(table.limit(0), ["user"], "_t", "stage", 60).count() == 0


def test_a_key_is_dealt_to_its_ranges(spark):
    table = spark.createDataFrame([], "user int, ts timestamp, stage string")
    text = temporal.sessions(table, ["user"], "ts", "stage", 60)._jdf.queryExecution().executedPlan().toString()
    lowest = [x for x in text.split("== Initial Plan ==")[-1].splitlines() if "Exchange hashpartitioning" in x][-1]
    assert "_range" in lowest


def test_metadata_as_variant(spark):
    texts = ['{"k": 7}', '{"k": "9"}', '{"k": "x"}', '{"k": null}', "{}", '{"k": {"a": 1}}', '{"k": 7', "", None]
    table = spark.createDataFrame(list(enumerate(texts)), "id int, metadata_json string")
    found = monitoring.with_metadata(table, {"k": "bigint"}).withColumn("valid", F.col("metadata").isNotNull()).orderBy("id").collect()
    assert [r.k for r in found] == [7, 9, None, None, None, None, None, None, None]
    assert [r.valid for r in found] == [True] * 6 + [False] * 3
    schemas = {r.id: r for r in monitoring.metadata_schemas(table, "id").collect()}
    assert schemas[0].metadata_schema == "OBJECT<k: BIGINT>" and schemas[5].metadata_schema == "OBJECT<k: OBJECT<a: BIGINT>>"
    assert [(schemas[i].valid, schemas[i].malformed, schemas[i].missing) for i in (0, 6, 8)] == [(1, 0, 0), (0, 1, 0), (0, 0, 1)]


def test_followed_health_goes_on_after_a_failure(spark, tmp_path, monkeypatch):
    landing, table, checkpoint = (str(tmp_path / x) for x in ("landing", "table", "checkpoint"))
    schema = spark.createDataFrame([], "recorded_at timestamp, failed boolean").schema
    day = dt.datetime(2024, 1, 1)

    def deliver(rows):
        spark.createDataFrame([(day + dt.timedelta(days=d), f) for d, f in rows], schema).coalesce(1).write.mode("append").parquet(landing)

    def follow():
        health.follow(spark, landing, schema, table, checkpoint, "1 day", None, "2 days")

    def state():
        return sorted((r.window_start, r.n_rows, r.n_failed) for r in health.latest(spark, table).collect())

    deliver([(0.5, True), (0.6, False), (4.0, True)])
    follow()
    follow()  # nothing new
    assert state() == [(day, 2, 1), (day + dt.timedelta(days=4), 1, 1)]

    # The second delivery has a row of a closed window, and the first attempt dies after its write.
    deliver([(0.7, True), (3.0, False), (4.5, True)])
    store, died = health._store, []

    def dies(changed, path):
        store(changed, path)
        if not died:
            died.append(path)
            raise RuntimeError("lost")

    monkeypatch.setattr(health, "_store", dies)
    with pytest.raises(Exception, match="lost"):
        follow()
    follow()
    assert died
    assert state() == [(day, 2, 1), (day + dt.timedelta(days=3), 1, 0), (day + dt.timedelta(days=4), 2, 2)]
    late = health.with_late_rows(health.latest(spark, table), spark.read.schema(schema).parquet(landing), "1 day", None)
    assert sorted((r.window_start, r.late_rows) for r in late.collect()) == [(day, 1), (day + dt.timedelta(days=3), 0), (day + dt.timedelta(days=4), 0)]
