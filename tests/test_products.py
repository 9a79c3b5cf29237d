"""Exact products of decimals of any size."""

import random
from decimal import Decimal, getcontext

from pyspark.sql import functions as F

from touchstone.functions import finite_decimal
from touchstone.plans.operations import _product_matches


def test_products_match_exact_arithmetic(spark):
    getcontext().prec = 80
    rng = random.Random(8)
    rows = []
    for _ in range(400):
        a, b = (Decimal(rng.randrange(-(10 ** rng.randrange(1, 16)), 10 ** rng.randrange(1, 16))).scaleb(-rng.randrange(0, 5)) for _ in range(2))
        for off in ("0", "0.0000009", "0.0000011", "-0.0000009", "-0.0000011", "1", "0.5"):
            left = (a * b + Decimal(off)).quantize(Decimal("1e-10"))
            if abs(left) < Decimal(10) ** 27:
                rows.append((format(left, "f"), format(a, "f"), format(b, "f"), abs(left - a * b) <= Decimal("0.000001")))
    rows += [("300000000000", "100000000000", "3", True), ("300000000001", "100000000000", "3", False), ("x", "1", "1", None), ("1", None, "1", None)]
    rows += [("1", "1" + "0" * 20, "1" + "0" * 20, False), ("10000000000000000000000", "100000000000", "100000000000", True)]
    frame = spark.createDataFrame(rows, "l string, a string, b string, want boolean")
    got = frame.withColumn("got", _product_matches(*[finite_decimal(F.col(c)) for c in ("l", "a", "b")]))
    wrong = got.where("NOT (got <=> want)")
    assert wrong.collect() == [] and got.where("want").count() > 400
