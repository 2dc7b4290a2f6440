import os

import pytest

from annolytics.operators.joins import join_unique
from annolytics.session import clean, forget, persist_table


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_unique_is_the_plain_join(spark, how):
    big = spark.createDataFrame([(i % 3 if i % 2 else i, i) for i in range(3000)] + [(None, -1)], "k long, v long")
    small = spark.createDataFrame([(i, str(i)) for i in range(0, 3000, 3)], "k long, s string")
    want = sorted(map(tuple, big.join(small, "k", how).collect()), key=str)
    for limit in (10_000, 5):
        assert sorted(map(tuple, join_unique(big, small, "k", how, limit).collect()), key=str) == want


def test_written_tables_are_deleted(spark):
    t = persist_table(spark.range(5).toDF("x"), "t")
    path = t._annolytics_path
    assert os.path.isdir(path) and t.count() == 5
    forget(t, spark.range(1).toDF("x"))
    assert not os.path.exists(path)
    path = persist_table(spark.range(2).toDF("x"), "u")._annolytics_path
    assert clean(spark) >= 1 and not os.path.exists(path)
