"""Column helpers against the Python behaviour they reproduce."""


from kpiforge.functions import category_label, pct_label, python_title, rnd

WORDS = ["cama_mesa_banho", "2nd hand", "they're", "ÉCOLE élève", "x", "", "a1b", "en_Brand#13",
         "MiXeD_caSe", "d'água"]
# Not covered: the four title-case digraphs (e.g. U+01C5), which Python maps to
# their title form and Spark can only upper-case.


def test_python_title(spark):
    df = spark.createDataFrame([(w,) for w in WORDS] + [(None,)], "s string")
    got = [r[0] for r in df.select(python_title("s")).collect()]
    assert got == [w.title() for w in WORDS] + [None]
    got2 = [r[0] for r in df.select(category_label("s")).collect()]
    assert got2 == [w.replace("_", " ").title() for w in WORDS] + [None]


def test_pct_label_matches_python_format(spark):
    vals = [0.25, 0.35, 0.15, 2.5, 45.25, 99.95, 100.0, 0.0, 12345.65, -0.04]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(pct_label("x")).collect()]
    assert got == [f"{v:.1f}%" for v in vals]


def test_rnd_half_away_from_zero(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (-1.005,), (1.0 / 3,)], "x double")
    got = [r[0] for r in df.select(rnd("x", 2)).collect()]
    assert got == [0.13, 2.68, -1.01, 0.33]


def test_scale_settings():
    from kpiforge.session import scale_settings
    assert scale_settings(0)["spark.sql.shuffle.partitions"] == "200"
    assert scale_settings(10 << 40)["spark.sql.shuffle.partitions"] == str(40960)   # 10 TiB / 256 MiB
    assert scale_settings(100 << 40)["spark.sql.shuffle.partitions"] == str(409600)  # 100 TiB
    assert scale_settings(1, least=7)["spark.sql.shuffle.partitions"] == "7"
