"""The plans behind the operators: what is scanned, pushed down, broadcast, and what never appears."""

import pytest
from pyspark.sql import functions as F

from siftwork.catalog import QUERIES
from siftwork.functions.labels import parse_labels
from siftwork.operators.encode import FeatureEncoder
from siftwork.operators.metrics import balanced_weights
from siftwork.operators.outliers import range_filter, rejection_counts
from siftwork.operators.profile import missing_profile
from siftwork.operators.scale import FeatureScaler


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet")


def test_range_filter_reaches_the_scan(orders):
    text = plan(range_filter(orders.select("o_orderkey", "o_totalprice"), {"o_totalprice": (0, 450000)}))
    assert "o_totalprice" in text.split("PushedFilters: [")[1].split("]")[0]
    assert "o_orderpriority" not in text.split("ReadSchema:")[1]


def test_profile_scans_are_narrow(orders):
    """One scan for the counts, one for the digests; no copy of a row per column."""
    text = plan(missing_profile(orders, ["o_totalprice", "o_custkey"]))
    assert text.count("FileScan parquet") == 2 and "Expand" not in text
    assert all("o_orderdate" not in part for part in text.split("ReadSchema:")[1:])


def test_scaling_is_a_projection(orders):
    model = FeatureScaler("standard", exclude=["o_orderkey"]).fit(orders)
    text = plan(model.transform(orders))
    assert "Exchange" not in text and "Join" not in text


def test_encoders_do_not_shuffle_rows(orders):
    methods = {"o_orderstatus": "onehot", "o_orderpriority": "target"}
    model = FeatureEncoder(methods, "o_orderstatus").fit(orders)
    text = plan(model.transform(orders))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_class_weights_are_broadcast(orders):
    text = plan(balanced_weights(orders, "o_orderpriority"))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_labels_stay_in_the_jvm(orders):
    text = plan(orders.select(parse_labels(F.col("o_orderpriority"))))
    assert "Python" not in text


def test_reasons_are_counted_in_each_task_first(orders):
    text = plan(rejection_counts(orders, {"o_totalprice": (0, 1000)}))
    assert "partial_count" in text


@pytest.mark.parametrize("name", ["b5_reject_reasons", "c8_zero_fill", "e3_clean_list", "f1_top_labels", "g5_derived_features",
                                  "k11_report", "l6_box_stats", "l9_spearman", "l11_top_categories", "m4_explode_scores"])
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "EvalPython" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
