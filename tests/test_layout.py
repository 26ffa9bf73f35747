"""Results must not depend on how the input is split or how wide shuffles
are: rerun deterministic queries under very different layouts."""

import pytest

import __spark_entry__ as E
from conftest import SF01

LAYOUT_FREE = ["stratified_sample", "exact_sample", "shards", "repeat", "batches", "bands_pivot",
               "label_recode", "features", "iou_per_class", "best_epoch", "missing_bands", "limit_k"]


def _rows(spark, name):
    return sorted(tuple(r) for r in E.queries()[name](spark, SF01).collect())


@pytest.mark.parametrize("name", LAYOUT_FREE)
def test_same_result_under_other_layout(spark, name):
    base = _rows(spark, name)
    keys = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")   # many small input splits
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        other = _rows(spark, name)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert base == other
