"""The mapped rows lie evenly over the tasks, however the input's files are cut."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cohortflow.session import compiled_methods
from cohortflow.sources.adapter import adapt_events, adapt_orders

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("adapt", [adapt_events, adapt_orders])
def test_one_row_group_of_many_splits_is_mapped_by_many_tasks(spark, adapt):
    """One row group goes to one of its file's splits; the others read nothing."""
    settings = {"spark.sql.files.maxPartitionBytes": "512", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = [r["count"] for r in adapt(spark, SF).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(rows) < sum(rows) / 2


def test_landing_splits_the_mapping_into_compiled_methods(spark):
    """One generated method of more than 8,000 bytes would be interpreted; the session's limit is as it was afterwards."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with compiled_methods(spark):
        assert int(spark.conf.get(name)) <= 8000
    assert spark.conf.get(name) == before
