"""Values survive being written as SQL literals."""

import random
import string

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.functions.literals import sql_literal, text_literal


def test_text(spark):
    rng = random.Random(1)
    letters = string.printable + "é中 😀%_$`{}:?\\'\""
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(12))) for _ in range(200)]
    row = spark.range(1).select(*[F.expr(text_literal(t)).alias(f"c{i}") for i, t in enumerate(texts)])
    assert list(row.first()) == texts


def test_numbers(spark):
    cases = [(T.LongType(), -(2**63)), (T.LongType(), 2**63 - 1), (T.ByteType(), -128), (T.ShortType(), 7)]
    row = spark.range(1).select(*[F.expr(sql_literal(v, t)).alias(f"c{i}") for i, (t, v) in enumerate(cases)])
    assert list(row.first()) == [v for _, v in cases]
    assert [f.dataType for f in row.schema] == [t for t, _ in cases]
