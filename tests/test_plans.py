"""Shapes of physical plans: shuffles, pruning."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def plan_of(spark, name):
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("frame_labels", 1),  # one layout serves every lag and lead
        ("label_counts", 1),  # and the counts after it
        ("wash_composition", 1),
        ("duration_histogram", 1),
        ("qa_vectors", 1),
        ("rigid_transform", 0),  # joints of a frame never leave its row
        ("drop_to_ground", 0),
        ("command_table", 0),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    plan = plan_of(spark, name)
    assert plan.count("Exchange ") == shuffles, plan


def test_narrow_scan(spark):
    schema = plan_of(spark, "duration_histogram").split("ReadSchema: ")[1]
    assert schema.startswith("struct<o_orderstatus:string,o_totalprice:double>")


@pytest.mark.parametrize(
    "name", ["dataset_apply", "dataset_swaps", "dataset_rollback", "bbox_crop", "balance_select", "balance_audit"]
)
def test_intermediates_are_evaluated_once(spark, name):
    """What several branches read is written once, so the last plan stays small."""
    assert plan_of(spark, name).count("Exchange ") <= 12
