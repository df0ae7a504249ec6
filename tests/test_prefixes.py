"""Running sums over written tables, and keys of rows without one."""

import random

import pytest
from pyspark.sql import functions as F

from sparkrisk.operators.prefixes import running_sums, written
from sparkrisk.plans.prepare import with_row_id


@pytest.mark.parametrize("bits", [0, 2, 16])
def test_sums_equal_a_plain_loop(spark, bits):
    r = random.Random(1)
    data = [(r.choice([None, "a", "b"]), k, r.randint(0, 9)) for k in range(300)]
    table = written(spark.createDataFrame(data, "g string, k int, v int").repartition(7), "test", [F.asc("k")])
    got = {x["k"]: x for x in running_sums(table, ["g"], ["v"], bits).collect()}
    assert len(got) == 300
    for g, k, v in data:
        earlier = [c for a, b, c in data if a == g and b < k]
        later = [c for a, b, c in data if a == g and b > k]
        assert (got[k]["v_before"], got[k]["v_all"]) == (sum(earlier), sum(earlier) + v + sum(later))
        assert (got[k]["following"] and got[k]["following"]["v"]) == (later[0] if later else None)


def test_a_row_that_fills_a_third_is_numbered_in_blocks(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"), F.lit(None).cast("string").alias("y"))
    once = sorted(r["row_id"] for r in with_row_id(rows, block_bits=5).collect())
    again = sorted(r["row_id"] for r in with_row_id(rows.repartition(11), block_bits=3).collect())
    assert once == again and len(set(once)) == 6000
    hot = [k for k in once if int(k.split("-")[1]) > 1]
    assert len({k.split("-")[0] for k in hot}) == 1 and len(hot) == 1999
    assert with_row_id(rows.limit(0)).collect() == []
