import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapline.operators.sequence import number_within_key


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 1_000_000])
def test_matches_plain_window(spark, rows_per_bucket):
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", "c"]), float(rng.randint(0, 50)), i) for i in range(300)]
    rows.append(("hot", 1.0, 1000))  # single-row key
    df = spark.createDataFrame(rows, "k string, t double, id int")
    ours = number_within_key(df, ["k"], F.col("t"), ["t", "id"], "t",
                             rows_per_bucket=rows_per_bucket)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("id", F.row_number().over(w).alias("n_ref"), F.lag("t").over(w).alias("p_ref"))
    j = ours.join(ref, "id").collect()
    assert len(j) == len(rows)
    assert all(r.n == r.n_ref and r.prev == r.p_ref for r in j)
