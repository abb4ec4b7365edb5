"""Types of undeclared columns, whole-column casts, rows that do not fit, and
bytes that are not UTF-8."""

import io
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from kpiforge.__main__ import main
from kpiforge.plans.registry import Registry
from kpiforge.plans.runner import run_all
from kpiforge.sources.catalog import ensure_databases, load_table, replace_table
from kpiforge.sources.columns import (BOOLEAN, DECIMAL, INTEGER, TEXT, TIMESTAMP, castable, inferred_types, kind,
                                      profile, with_numeric_columns)
from kpiforge.sources.csv_ingest import (BYTES, SURPLUS, UNREADABLE, NotUtf8, field_count, ingest_directory, layout,
                                         read_csv, scan_csv)
from tests.test_ingest_and_runner import CUSTOMERS, ITEMS, ORDERS

VALUES = {
    INTEGER: ["0", "7", "-12", "123456789012345678", " 5 "],
    DECIMAL: ["1.5", "-0.25", ".5", "3.", "1e5", "2.5E-3", "inf", "-Infinity", "0.0"],
    TIMESTAMP: ["2018-01-01", "2018-01-01 10:00", "2017-12-31T23:59:59.123456"],
    BOOLEAN: ["True", "false", "TRUE"],
    TEXT: ["x", "007", "-01", "+5511", "00.5", "12345678901234567890", "2018-02-31", "2018-1-1", "1,5", "0x1F", "1_000",
           "yes", "--1", "1.2.3", "٣"],
}


def test_kind_of_every_value(spark):
    rows = [(v, k) for k, vs in VALUES.items() for v in vs] + [(None, 0)]
    got = spark.createDataFrame(rows, "v string, k int").select("v", "k", kind(F.col("v")).alias("got")).collect()
    assert [(r.v, r.got) for r in got if r.k != r.got] == []


def test_kinds_merge_in_any_order_in_one_pass(spark):
    rng = random.Random(3)
    rows = [tuple(rng.choice(VALUES[k]) if rng.random() < .8 else None for k in VALUES) + (None, rng.choice("0 1 2.5".split()))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "i string, d string, t string, b string, x string, none string, mixed string")
    for parts in (1, 7, 31):
        df_p = df.repartition(parts)
        types = {c: t.simpleString() for c, t in inferred_types(df_p, df.columns).items()}
        assert types == {"i": "bigint", "d": "double", "t": "timestamp_ntz", "b": "boolean", "x": "string",
                         "none": "string", "mixed": "double"}
    from tools.explain_plans import plan_text
    plan = plan_text(df.repartition(3).agg(*[F.bit_or(kind(F.col(c))) for c in df.columns]))
    assert plan.count("SinglePartition") == 1 and "EvalPython" not in plan


def pandas_like(text):
    """Types pandas gives, but for its losses: leading zeros stay text, integers
    with gaps stay integers."""
    frame, raw = pd.read_csv(io.StringIO(text)), pd.read_csv(io.StringIO(text), dtype=str)
    out = {}
    for c in frame.columns:
        v = raw[c].dropna()
        if len(v) and v.str.match(r"[+-]?0\d|\+").any():
            out[c] = "string"
        elif frame[c].dtype == "int64" or (frame[c].dtype == "float64" and len(v) and v.str.fullmatch(r"-?\d+").all()):
            out[c] = "bigint"
        elif frame[c].dtype == "float64" and len(v):
            out[c] = "double"
        elif frame[c].dtype == "bool":
            out[c] = "boolean"
        else:
            out[c] = "string"
    return out, raw


@pytest.mark.parametrize("seed", range(4))
def test_unknown_file_equals_a_pandas_like_reading(spark, tmp_path, seed):
    rng = random.Random(seed)
    makers = [lambda: str(rng.randrange(1000)), lambda: f"{rng.uniform(-5, 5):.3f}", lambda: rng.choice(["True", "False"]),
              lambda: f"{rng.randrange(10**5):05d}", lambda: rng.choice(["a", "b,c", 'd"e', "1"]),
              lambda: rng.choice(["1", "NA", "2", "null"]), lambda: rng.choice(["1", "2.5", "", "NaN"]), lambda: "NA"]
    header = [f"c{i}" for i in range(len(makers))]

    def quoted(v):
        return '"' + v.replace('"', '""') + '"' if set(v) & set(',"') else v
    lines = [",".join(header)] + [",".join(quoted(m()) for m in makers) for _ in range(60)]
    (tmp_path / "unknown.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    want, raw = pandas_like("\n".join(lines) + "\n")
    got = read_csv(spark, str(tmp_path / "unknown.csv"), "unknown")
    assert dict(got.dtypes) == want
    rows = got.collect()
    for c, t in want.items():
        mine = [r[c] for r in rows]
        theirs = [None if pd.isna(v) else int(v) if t == "bigint" else float(v) if t == "double" else v == "True"
                  if t == "boolean" else v for v in raw[c]]
        assert mine == theirs, c
    off = read_csv(spark, str(tmp_path / "unknown.csv"), "unknown", infer=False)
    assert {t for _, t in off.dtypes} == {"string"}


def test_timestamps_are_inferred_and_mixed_columns_stay_text(spark, tmp_path):
    (tmp_path / "e.csv").write_text("at,mixed,day\n2018-01-01 10:00:00,2018-01-01,2018-01-31\n2018-01-02,5,2018-02-30\n", "utf-8")
    df = read_csv(spark, str(tmp_path / "e.csv"), "e")
    assert dict(df.dtypes) == {"at": "timestamp_ntz", "mixed": "string", "day": "string"}
    assert [r.day for r in df.collect()] == ["2018-01-31", "2018-02-30"]


def test_one_bad_value_leaves_the_column_whole(spark, tmp_path):
    path = str(tmp_path / "olist_order_items_dataset.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(ITEMS.replace("20.00", "twenty"))
    scan = scan_csv(spark, path, "order_items")
    assert scan.kept_as_text == ["price"]
    types = dict(scan.rows.dtypes)
    assert types["price"] == "string" and types["freight_value"] == "decimal(12,2)"
    assert [r.price for r in scan.rows.collect()] == ["10.00", "twenty", "30.00"]
    rep = run_all(spark, str(tmp_path), Registry(), raw_db="raw_whole", out_db="an_whole")
    assert rep.ingested == {"order_items": 3} and rep.kept_as_text == {"order_items": ["price"]}
    assert dict(spark.table("raw_whole.order_items").dtypes)["price"] == "string"
    with pytest.raises(Exception):
        ingest_directory(spark, str(tmp_path), "raw_whole_strict", "strict")


def test_numbers_kept_as_text_in_a_kpi_table(spark):
    ensure_databases(spark, "an_text")
    df = spark.sql("SELECT * FROM VALUES ('1.50', '007', 'SP', '2', 1), ('x', '2', 'RJ', NULL, 2) AS t(a, b, uf, c, n)")
    replace_table(df, "an_text", "t")
    got = load_table(spark, "t", "an_text", numeric=True, text=("uf",))
    assert got.dtypes == [("a", "string"), ("b", "double"), ("uf", "string"), ("c", "double"), ("n", "int")]
    assert sorted(r.a for r in got.collect()) == ["1.50", "x"]
    assert load_table(spark, "t", "an_text").dtypes == df.dtypes
    assert with_numeric_columns(df.limit(0)).dtypes[0] == ("a", "double")
    types = {c: t.simpleString() for c, t in castable(df, {"a": DoubleType(), "c": DoubleType()}).items()}
    assert types == {"a": "string", "c": "double"}
    assert profile(df, [], {}) == {}


MESSY = (CUSTOMERS + "c3,u3,04000\n" + "c4,u4,1,x,SP,extra\n" + '"c5","u,5",2,"a ""b"", c",SP\n' + "\n"
         + "c4,u4,1,x,SP,extra\n" + "c6\n" + "c7,u7,1,y,RJ,,\n")


def test_rows_that_do_not_fit(spark, tmp_path):
    path = tmp_path / "olist_customers_dataset.csv"
    path.write_text(MESSY, encoding="utf-8")
    scan = scan_csv(spark, str(path), "customers")
    rows = {r.customer_id: r for r in scan.rows.collect()}
    assert set(rows) == {"c1", "c2", "c3", "c5", "c6"}
    assert rows["c3"].customer_zip_code_prefix == "04000" and rows["c3"].customer_state is None
    assert rows["c5"].customer_city == 'a "b", c' and rows["c6"].customer_unique_id is None
    assert scan.counts.get == {"rejected": 3, "padded": 2}
    got = sorted((r.line, r.rows, r.reason, r.record) for r in scan.rejects.collect())
    assert got == [(5, 2, SURPLUS, "c4,u4,1,x,SP,extra"), (10, 1, SURPLUS, "c7,u7,1,y,RJ,,")]
    with pytest.raises(Exception):
        ingest_directory(spark, str(tmp_path), "raw_m1", "strict")
    with pytest.raises(Exception):
        ingest_directory(spark, str(tmp_path), "raw_m2", "padded")
    assert not spark.catalog.tableExists("raw_m2.customers")
    out = ingest_directory(spark, str(tmp_path), "raw_m3", "quarantine")
    assert (out, out.padded, out.rejected) == ({"customers": 5}, {"customers": 2}, {"customers": 3})
    assert spark.table("raw_m3_rejects.customers").agg(F.sum("rows")).first()[0] == 3
    with pytest.raises(ValueError):
        ingest_directory(spark, str(tmp_path), "raw_m4", "lenient")


def test_short_rows_are_padded_by_default(spark, tmp_path, capsys, caplog):
    (tmp_path / "olist_customers_dataset.csv").write_text(CUSTOMERS + "c3,u3\n", encoding="utf-8")
    (tmp_path / "olist_orders_dataset.csv").write_text(ORDERS, encoding="utf-8")
    with caplog.at_level("WARNING"):
        out = ingest_directory(spark, str(tmp_path), "raw_short")
    assert out == {"customers": 3, "orders": 3} and out.padded == {"customers": 1} and out.rejected == {}
    assert "customers: 1 short rows padded with nulls" in caplog.messages
    main(["run", str(tmp_path), "--raw-db", "raw_short2", "--out-db", "an_short2", "--rows", "quarantine"])
    said = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert said["ingested"]["customers"] == 3 and said["padded"] == {"customers": 1} and "rejected" not in said


def test_rows_that_span_lines_and_part_files(spark, tmp_path):
    folder = tmp_path / "notes"
    os.makedirs(folder)
    (folder / "p0.csv").write_text('id,text\n1,"a\nb"\n2,x,y\n3\n', encoding="utf-8")
    (folder / "p1.csv").write_text('id,text\n4,"c ""d"""\n2,x,y\n', encoding="utf-8")
    scan = scan_csv(spark, f"{folder}/*.csv", "notes")
    assert sorted((r.id, r.text) for r in scan.rows.collect()) == [(1, "a\nb"), (3, None), (4, 'c "d"')]
    got = sorted((r.file.rsplit("/", 1)[1], r.line, r.rows, r.reason, r.record) for r in scan.rejects.collect())
    assert got == [("p0.csv", None, 1, SURPLUS, "2,x,y"), ("p1.csv", None, 1, SURPLUS, "2,x,y")]


def test_lines_count_across_blocks_of_a_file(spark, tmp_path):
    n = 4000
    bad = {17, 1234, 2500, 3999}
    lines = ["k,v"] + [f"{i},{'x' * 40}" + (",more" if i in bad else "") for i in range(n)]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        scan = scan_csv(spark, str(tmp_path / "t.csv"), "t")
        assert scan.rows.rdd.getNumPartitions() > 4
        assert sorted(r.line for r in scan.rejects.collect()) == sorted(i + 2 for i in bad)
        assert scan.rows.count() == n - len(bad)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_bytes_that_are_not_utf8(spark, tmp_path):
    path = tmp_path / "olist_customers_dataset.csv"
    path.write_bytes(CUSTOMERS.encode() + b"c3,u3,1,S\xe3o Paulo,SP\n" + "c4,u4,1,São,SP\n".encode())
    found = layout(spark, str(path))
    assert found.lines and list(found.not_utf8.values()) == [1]
    for mode in ("strict", "padded"):
        with pytest.raises(NotUtf8, match="1 lines of .*olist_customers_dataset.csv"):
            ingest_directory(spark, str(tmp_path), "raw_u1", mode)
    out = ingest_directory(spark, str(tmp_path), "raw_u2", "quarantine")
    assert out == {"customers": 3} and out.rejected == {"customers": 1}
    r = spark.table("raw_u2_rejects.customers").first()
    assert (r.line, r.rows, r.reason) == (4, 1, BYTES) and r.record.startswith("c3,u3,1,S")
    assert "São" in [x.customer_city for x in spark.table("raw_u2.customers").collect()]
    clean = tmp_path / "clean"
    os.makedirs(clean)
    (clean / "olist_customers_dataset.csv").write_text(CUSTOMERS + "c9,u,1,�,SP\n", encoding="utf-8")
    assert ingest_directory(spark, str(clean), "raw_u3", "quarantine") == {"customers": 3}  # the sign itself is text


def test_field_count(spark):
    cases = {"a,b": 2, "": 1, '"a,b",c': 2, 'a,"b ""x"", y",c': 3, ",,": 3, 'a"b,c"d': 2, '"' + "x," * 20000 + '",b': 2,
             '""': 1, '"a","b"': 2}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "r string, n int")
    assert df.filter(field_count(F.col("r")) != F.col("n")).collect() == []
    assert UNREADABLE != SURPLUS
