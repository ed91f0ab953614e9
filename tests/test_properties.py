"""Property checks (hypothesis) of the exact distributed statistics against NumPy."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.stats import exact_quantiles

values = st.lists(
    st.one_of(st.integers(-50, 50).map(float), st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
    min_size=1, max_size=400,
)
probs = st.lists(st.floats(0.0, 1.0), min_size=1, max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=values, ps=probs, bins=st.sampled_from([2, 50, 2048]))
def test_exact_quantiles_property(spark, vals, ps, bins):
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(3)
    got = exact_quantiles(df, ["v"], ps, bins=bins)["v"]
    want = np.quantile(np.array(vals), ps, method="linear")
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    groups=st.lists(st.integers(0, 3), min_size=1, max_size=300),
    seed=st.integers(0, 1000),
)
def test_split_ranks_property(spark, groups, seed):
    """Digest-bucket ranks equal a plain row_number for any group sizes (incl. one dominant group)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tessera.operators.ranking import hash_row_number
    from tessera.operators.splits import split_key

    df = spark.createDataFrame([(i, g) for i, g in enumerate(groups)], "id bigint, g int").withColumn("k", split_key("id", seed))
    ours = {(r.id, r.rn) for r in hash_row_number(df, "k", "id", ["g"], hex_digits=2).select("id", "rn").collect()}
    ref = {(r.id, r.rn) for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("k", "id"))).collect()}
    assert ours == ref
