"""Rules that earlier rounds had in part."""

from skyplan.operators import output, schedule, validate
from skyplan.sources import text
from skyplan.sources.report import report_html


def test_export_fills_missing_targets(spark):
    bare = spark.createDataFrame([("x", 1.0, 2.0)], "ppc_code string, ppc_ra double, ppc_dec double")
    row = output.export_pointings(bare).first()
    assert row.ppc_allocated_targets == [] and row.ppc_priority == 1.0
    given = bare.selectExpr("*", "array('a') AS ppc_allocated_targets")
    assert output.export_pointings(given).first().ppc_allocated_targets == ["a"]


def test_report_names_the_design(spark):
    page = report_html(spark.createDataFrame([(7, "c", True)], "design_id long, ppc_code string, flag_ppc_code boolean"), "t")
    assert page.index("designId") < page.index("ppc_code") and "design_id" not in page


def test_every_duplicate_is_listed(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e"), (None, "f")], "cobra int, obj string")
    got = sorted(tuple(r) for r in validate.duplicate_values(df.where("cobra is not null"), "cobra", "obj", "dup").collect())
    assert got == [("dup", "1", "a"), ("dup", "1", "b"), ("dup", "1", "c")]


def test_slots_of_proposals(spark):
    e = spark.createDataFrame([("s24a-001", "3/2", "20:00", "24:00"), ("S24A-001", "3/1", "20:00", "24:00"), ("S24A-QN2", "3/1", "1:00", "2:00")], "proposal_id string, date string, start string, stop string")
    got = {r.proposal_id: [s.date for s in r.slots] for r in text.slots_by_proposal(e).collect()}
    assert got == {"S24A-001": ["3/1", "3/2"], "S24A-QN2": ["3/1"]}


def test_slew_lines_of_other_forms(spark):
    lines = ["slew time is 12.5 sec", "assigning ob/a b/c (x)", "slew time is fast sec", "assigning ob/d(x)", "slew time is 3 sec", "assigning d(x)", "slew time is 4 sec", "assigning ob/e", "slew time is 5.25 sec now", "assigning x y/f(z)"]
    df = spark.createDataFrame([("log", i, x) for i, x in enumerate(lines)], "log string, n int, line string")
    assert {(r.ppc_code, r.slew_time) for r in schedule.slew_times(df).collect()} == {("a b/c", 12.5), ("f", 5.25)}
