"""A whole night from its tables."""

import datetime as dt

from skyplan.run import STEPS, Settings, main, run


def inputs(spark):
    target = spark.createDataFrame(
        [(f"P{k % 3}", f"ob{k}", 1 if k % 7 else 2, 900.0 * (1 + k % 3), False, 10.0 + 0.05 * (k % 10), 1.0 + 0.05 * (k // 10), k % 4, 0.0, 0.0, 0.0) for k in range(80)],
        "proposal_id string, ob_code string, input_catalog_id int, effective_exptime double, is_medium_resolution boolean, ra double, dec double, priority int, pmra double, pmdec double, parallax double",
    )
    proposal = spark.createDataFrame([(f"P{k}", 20.0, 5.0, 5.0 + k) for k in range(4)], "proposal_id string, allocated_time_lr double, allocated_time_mr double, rank double")
    catalog = spark.createDataFrame([(1, True), (2, False)], "input_catalog_id int, active boolean")
    log = spark.createDataFrame([("P0", "ob0", 900.0), ("P1", "ob1", 450.0)], "psl_id string, ob_code string, eff_exptime_done_real double")
    nights = [(dt.date(2024, 1, d), dt.datetime(2024, 1, d, 5), dt.datetime(2024, 1, d, 6)) for d in (1, 2)]
    return {"target": target, "proposal": proposal, "catalog": catalog, "log": log, "windows": spark.createDataFrame(nights, "night date, start timestamp, stop timestamp")}


def test_night(spark, tmp_path):
    given = inputs(spark)
    s = Settings.of({"ppp": {"n_pointings": 3, "slots_per_night": 2, "fibers": 20, "resolution": "L"}})
    out = run(spark, given, str(tmp_path), s)
    assert tuple(out) == STEPS
    codes = [r.ppc_code for r in out["pointings"].orderBy("ppc_code").collect()]
    assert codes == ["que_L_240101_1", "que_L_240101_2", "que_L_240101_3"]
    # 80 targets less those of the inactive catalogue, and the one that is done
    assert out["targets"].count() == sum(1 for k in range(80) if k % 7) and all(r.exptime > 0 for r in out["targets"].collect())
    slots = out["schedule"].collect()
    assert len({r.ppc_code for r in slots}) == len(slots) == 3 and all(5 * 3600 <= (r.obstime.hour * 3600 + r.obstime.minute * 60) <= 6 * 3600 - 1260 for r in slots)
    assert out["plan"].count() == sum(len(r.ppc_allocated_targets) for r in out["pointings"].collect())
    assert out["allocations"].agg({"exptime_assign": "sum"}).first()[0] == 900.0 * out["plan"].count()
    assert out["completion"].count() == 4 and out["violations"].count() == 0 and out["frames"].count() == 3
    again = run(spark, given, str(tmp_path), Settings(skip=frozenset(STEPS)))
    assert again["plan"].count() == out["plan"].count()


def test_command(spark, tmp_path, capsys):
    for name, table in inputs(spark).items():
        table.write.parquet(f"{tmp_path}/in/{name}.parquet")
    (tmp_path / "c.toml").write_text("[ppp]\nproposalIds = ['P1']\nslots_per_night = 1\n")
    main(["--tables", f"{tmp_path}/in", "--work-dir", f"{tmp_path}/out", "--config", f"{tmp_path}/c.toml", "--n-pointings", "1"])
    said = capsys.readouterr().out
    assert "pointings: 1 rows" in said and "schedule: 1 rows" in said
    assert {r.proposal_id for r in spark.read.parquet(f"{tmp_path}/out/targets").collect()} == {"P1"}
