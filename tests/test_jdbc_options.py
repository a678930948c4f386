"""JDBC argument checks. No database is started here (see README), so only validation is tested."""

import pytest

from citylake.sources.jdbc import read_jdbc


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:unused", "t", partition_column="id")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:unused", "t", partition_column="id", lower_bound=0, upper_bound=9, num_partitions=2,
                  predicates=["a = 1"])
