"""Registered queries read every row of their tables."""

import duckdb

from skyplan import plans
from skyplan.plans import catalog  # noqa: F401  registers the queries

SF = "/root/testdata/sf0.01"


def test_gaps_of_every_event(spark, monkeypatch):
    from skyplan.operators import schedule

    seen, real = [], schedule.schedule_gaps
    monkeypatch.setattr(schedule, "schedule_gaps", lambda observed, *a, **b: seen.append(observed) or real(observed, *a, **b))
    n = plans.QUERIES["schedule_gaps"](spark, SF).count()
    assert seen[0].count() == spark.read.parquet(f"{SF}/events.parquet").count() and n > 0
    con = duckdb.connect()
    con.sql(f"create view events as select * from '{SF}/events.parquet'")
    want = con.sql(plans.ORACLE_SQL["schedule_gaps"]).fetchall()
    assert sorted(map(tuple, plans.QUERIES["schedule_gaps"](spark, SF).select("night", "gap_start", "gap_stop").collect())) == sorted(want)


def test_every_night_is_scheduled(spark):
    con = duckdb.connect()
    scores = con.sql(f"SELECT CAST(ts AS DATE) AS night, user_id, sum(value) AS score FROM '{SF}/events.parquet' GROUP BY ALL ORDER BY night, score DESC, user_id").fetchall()
    want, taken = [], set()
    for night in sorted({x[0] for x in scores}):
        best = [x[1] for x in scores if x[0] == night and x[1] not in taken][:3]
        taken |= set(best)
        want += [(night, ppc, slot) for slot, ppc in enumerate(best, 1)]
    got = plans.QUERIES["greedy_schedule"](spark, SF).select("night", "ppc", "slot").collect()
    assert len({x[0] for x in want}) == 30 and sorted(map(tuple, got)) == sorted(want)


def test_every_line_is_parsed(spark, tmp_path):
    lines = [(1, 0, "hello"), (1, 1, "18:30-23:00 {grey} SPEC (someone; S24A-007)"), (1, 2, "18:30-23:00 {grey} SPEC (someone)"), (1, 4, None)]
    spark.createDataFrame(lines, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = plans.QUERIES["schedule_entries"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "S24A-101"), (1, 1, "S24A-007")]


def test_every_camera_and_line_counts(spark):
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    assert plans.QUERIES["camera_counts"](spark, SF).where("cam is null").agg({"n": "sum"}).first()[0] == n
    pairs = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey", "l_orderkey").distinct().count()
    assert plans.QUERIES["pointing_priority"](spark, SF).agg({"n_targets": "sum"}).first()[0] == pairs
