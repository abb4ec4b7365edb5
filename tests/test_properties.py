"""Property tests: the JVM-side helpers against the Python behaviour they
reproduce, on generated batches (one Spark job per batch)."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kpiforge.functions import pct_label, python_title, rnd

# letters whose case mapping is one-to-one in both Python and Java (no title-case
# digraphs, no expanding mappings such as sharp s)
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZáéíóúãõçâêôàüÁÉÍÓÚÃÕÇÂÊÔÀÜ"
TEXT = st.text(alphabet=LETTERS + "0123456789 _'-#.&/", max_size=24)
SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(TEXT, min_size=1, max_size=40))
def test_python_title_property(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "s string")
    assert [r[0] for r in df.select(python_title("s")).collect()] == [w.title() for w in words]


@SETTINGS
@given(st.lists(st.decimals(min_value=-1000, max_value=1000, places=4, allow_nan=False,
                            allow_infinity=False), min_size=1, max_size=40))
def test_pct_label_property(spark, values):
    xs = [float(v) for v in values]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r[0] for r in df.select(pct_label("x")).collect()] == [f"{x:.1f}%" for x in xs]


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=6, allow_nan=False,
                            allow_infinity=False), min_size=1, max_size=40),
       st.integers(min_value=0, max_value=3))
def test_rnd_is_sql_round_half_up(spark, values, n):
    xs = [float(v) for v in values]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(rnd("x", n)).collect()]
    q10, qn = Decimal("1e-10"), Decimal(1).scaleb(-n)
    want = [float(Decimal(repr(x)).quantize(q10, ROUND_HALF_UP).quantize(qn, ROUND_HALF_UP)) for x in xs]
    assert got == want
