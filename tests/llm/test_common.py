"""Shared helpers."""

import numpy as np
import pytest

from tracklake.llm.common import discard_materialized, materialize, mix, powers, spread


def test_materialized_tables_can_be_cleared(spark):
    df = materialize(spark.range(5).toDF("k"), "numbers")
    assert df.count() == 5
    discard_materialized(spark)
    with pytest.raises(Exception):
        df.count()


def test_spread_is_the_join(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "k long, a string")
    b = a.groupBy("k").count()
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert sorted(map(str, spread(a, b, ["k"], how).collect())) == sorted(map(str, a.join(b, ["k"], how).collect()))


def test_powers_and_mix():
    assert powers(3, 4).tolist() == [1, 3, 9, 27] and powers(7, 0).tolist() == []
    x = np.arange(10_000, dtype=np.uint64)
    assert len(np.unique(mix(x))) == len(x)
