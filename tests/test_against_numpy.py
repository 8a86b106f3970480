"""Generated values: the histogram bins equal numpy's default ``histogram`` (10 bins, as the source's plotting
call used), and the half-up rounding equals decimal arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions.columns import round2
from marquee.operators.distribution import equal_width_histogram

# means of half-star ratings over a few records: k / (2 n)
means = st.builds(lambda k, n: k / (2 * n), st.integers(1, 10 * 6), st.integers(1, 6)).filter(lambda x: x <= 5.0)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(means, min_size=1, max_size=40))
@example([1.5, 7 / 6, 4.5])  # 1.5 lies on the first edge: numpy puts it in the upper bin
def test_bins_match_numpy(spark, values):
    df = spark.createDataFrame([("g", float(v)) for v in values], "k string, v double")
    got = [r.num_users for r in equal_width_histogram(df, "k", "v").orderBy("bin").collect()]
    want, _ = np.histogram(np.array(values, dtype=float), bins=10)
    assert got == want.tolist()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 10), min_size=1, max_size=30))
def test_round2_is_half_up(spark, halves):
    ratings = [h / 2 for h in halves]
    df = spark.createDataFrame([(float(r),) for r in ratings], "rating float")
    got = df.agg(round2(F.avg("rating")).alias("r")).first().r
    exact = Decimal(sum(halves)) / Decimal(2 * len(halves))
    assert got == float(exact.quantize(Decimal("0.000001"), ROUND_HALF_UP).quantize(Decimal("0.01"), ROUND_HALF_UP))
