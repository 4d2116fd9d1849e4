import hashlib

import pytest
from pyspark.sql import functions as F

from revlake.llm import bitmap as B


@pytest.mark.parametrize("slice_bits", [1 << 24, 1 << 12])
def test_never_misses_and_mostly_rejects(spark, slice_bits):
    digest = lambda i: hashlib.md5(str(i).encode()).digest()
    held = spark.createDataFrame([(digest(i),) for i in range(0, 9000, 3)], "node binary")
    asked = spark.createDataFrame([(i, digest(i)) for i in range(9000)] + [(-1, None)], "i long, node binary")
    got = {r.i for r in asked.where(B.may_hold(F.col("node"), B.bitmap(held, 3000, slice_bits))).collect()}
    assert set(range(0, 9000, 3)) <= got and -1 not in got and len(got) < 3000 * 1.1
    none = B.bitmap(held.limit(0), 0)
    assert asked.where(B.may_hold(F.col("node"), none)).count() == 0
