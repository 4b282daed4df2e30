"""Rows aren't dealt by few keys, or moved twice, or with columns that nobody wants."""

import pytest
from pyspark.sql import functions as F

from skyplan.operators import design
from skyplan.plans import binding

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """As for tables that are too large to be sent to tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_module_by_target_not_by_fibre(spark, no_broadcast):
    fiber = spark.range(100).select((F.col("id") % 7).alias("fiber_id"), (F.col("id") % 20).cast("string").alias("ob_code"))
    own = spark.range(700).select((F.col("id") % 3).alias("fiber_id"))
    found = design.on_module(fiber, own, spark.range(10).select(F.col("id").cast("string").alias("ob_code")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [fiber_id" in plan  # the fibres of the module go to the rows, not the rows to few fibres
    assert {(r.fiber_id, r.ob_code) for r in found.collect()} == {(k % 7, str(k % 20)) for k in range(100) if k % 7 < 3 and k % 20 < 10}


def test_first_of_a_code_where_orders_are(spark, no_broadcast):
    once = binding.unique_targets(spark, SF)
    assert not [x for x in exchanges(once) if "ob_code" in x]
    assert once.count() == once.select("proposal_id", "ob_code").distinct().count() == binding.targets(spark, SF).select("proposal_id", "ob_code").distinct().count()


def test_wanted_columns_only(spark):
    some, every = binding.remaining_targets(spark, SF, ("priority",)), binding.remaining_targets(spark, SF)
    assert "ra" not in some.columns and "ra" in every.columns
    assert sorted(map(str, some.collect())) == sorted(map(str, every.select(*some.columns).collect()))
