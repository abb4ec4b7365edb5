"""KPI files in PostgreSQL's dialect: every form against DuckDB or by hand."""

import datetime as dt
import random
from decimal import Decimal

import duckdb
import pytest

from kpiforge.operators import otd, payments
from kpiforge.plans.registry import SQL_FOLDER, Registry, bind_sql
from kpiforge.plans.runner import run_kpis
from kpiforge.plans.sql_dialect import UnsupportedSql, to_spark

T0 = dt.datetime(2018, 1, 1)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)

    def stamp(p):
        return None if rng.random() < p else T0 + dt.timedelta(seconds=rng.randrange(90 * 86400), microseconds=rng.randrange(10**6))

    orders = [(i, f"c{rng.randrange(9)}", rng.choice(["delivered", "shipped"]), stamp(0), stamp(0.2), stamp(0.2),
               Decimal(rng.randrange(0, 10**6)) / 100, rng.choice([None, 1, 2, 3, 7])) for i in range(400)]
    names = "id, who, status, bought, came, promised, price, n"
    df = spark.createDataFrame(orders, "id int, who string, status string, bought timestamp_ntz, came timestamp_ntz, "
                                       "promised timestamp_ntz, price decimal(12,2), n int")
    con = duckdb.connect()
    con.execute("CREATE SCHEMA raw; CREATE TABLE raw.orders (id INT, who VARCHAR, status VARCHAR, bought TIMESTAMP, "
                "came TIMESTAMP, promised TIMESTAMP, price DECIMAL(12,2), n INT)")
    con.executemany(f"INSERT INTO raw.orders ({names}) VALUES (?,?,?,?,?,?,?,?)", orders)
    return {"orders": df}, con


# (text of the file, the same for DuckDB where its own reading differs)
FORMS = {
    "epoch": ("SELECT id, EXTRACT(EPOCH FROM (came::timestamp - bought::timestamp)) AS s FROM raw.orders",
              "SELECT id, date_diff('microsecond', bought, came) / 1e6 AS s FROM raw.orders"),
    "epoch of nested brackets": (
        "SELECT AVG(EXTRACT( EPOCH\n FROM ((came - bought)) ) / 86400) AS d, MAX(CASE WHEN came > promised THEN "
        "EXTRACT(EPOCH FROM came - promised) / 3600 END) AS h FROM raw.orders",
        "SELECT avg(date_diff('microsecond', bought, came)) / 864e8 AS d, max(CASE WHEN came > promised THEN "
        "date_diff('microsecond', promised, came) END) / 36e8 AS h FROM raw.orders"),
    "date_part": ("SELECT id, DATE_PART('epoch', came - bought) AS s FROM raw.orders",
                  "SELECT id, date_diff('microsecond', bought, came) / 1e6 AS s FROM raw.orders"),
    "filter, numeric, percent": (
        "SELECT who, ROUND(COUNT(*) FILTER (WHERE came > promised)::numeric / COUNT(*) * 100, 2) AS p FROM raw.orders "
        "GROUP BY who",
        "SELECT who, round(cast(count(CASE WHEN came > promised THEN 1 END) * 100.0 / count(*) AS DECIMAL(38,10)), 2) AS p "
        "FROM raw.orders GROUP BY who"),
    "numeric of an aggregate": (
        "SELECT status, ROUND(AVG(n)::numeric, 1) AS a, ROUND((AVG(price / NULLIF(n, 0)) * 100)::numeric, 1) AS b, "
        "SUM(price)::numeric AS c FROM raw.orders GROUP BY 1",
        "SELECT status, round(cast(avg(n) AS DECIMAL(38,10)), 1) AS a, round(cast(avg(cast(price AS DOUBLE) / n) * 100 "
        "AS DECIMAL(38,10)), 1) AS b, sum(price) AS c FROM raw.orders GROUP BY 1"),
    "ratio of averages": (
        "SELECT ROUND(AVG(EXTRACT(EPOCH FROM (promised - bought))) / NULLIF(AVG(EXTRACT(EPOCH FROM (came - bought))), 0) "
        "* 100::numeric, 1) AS p FROM raw.orders",
        "SELECT round(cast(avg(date_diff('microsecond', bought, promised)) / avg(date_diff('microsecond', bought, came)) "
        "* 100 AS DECIMAL(38,10)), 1) AS p FROM raw.orders"),
    "median": (
        "SELECT who, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY EXTRACT(EPOCH FROM (came - bought)) / 86400)::numeric, "
        "3) AS m, PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY price)::numeric AS q FROM raw.orders GROUP BY 1",
        "SELECT who, round(cast(quantile_cont(date_diff('microsecond', bought, came) / 864e8, 0.5) AS DECIMAL(38,10)), 3) AS m, "
        "quantile_cont(price::DOUBLE, 0.5) AS q FROM raw.orders GROUP BY 1"),
    "month": ("SELECT DATE_TRUNC('month', bought::timestamp) AS m, COUNT(*) AS n FROM raw.orders GROUP BY 1",
              "SELECT date_trunc('month', bought)::TIMESTAMP AS m, count(*) AS n FROM raw.orders GROUP BY 1"),
    "date bounds": ("SELECT id FROM raw.orders WHERE bought::timestamp >= '2018-02-01' AND bought < timestamp '2018-03-01'",
                    None),
    "simple case": ("SELECT CASE status WHEN 'delivered' THEN 'it''s here' ELSE status END AS s, COUNT(*) AS n "
                    "FROM raw.orders WHERE status != 'x' GROUP BY 1", None),
    "integers round": ("SELECT id, price::int AS a, CAST(price AS bigint) AS b, (-price)::integer AS c FROM raw.orders", None),
    "types": ("SELECT id::text AS a, n::double precision AS b, CAST(n AS float8) AS c, (n > 1)::bool AS d, "
              "id::varchar || 'x' AS e FROM raw.orders", None),
    "nulls last, first with DESC": (
        "SELECT came FROM raw.orders ORDER BY came DESC, id LIMIT 90",
        "SELECT came FROM raw.orders ORDER BY came DESC NULLS FIRST, id LIMIT 90"),
    "nulls last": ("SELECT id, n FROM raw.orders ORDER BY n, id LIMIT 320",
                   "SELECT id, n FROM raw.orders ORDER BY n NULLS LAST, id LIMIT 320"),
    "order in a window": (
        "SELECT id, ROW_NUMBER() OVER (PARTITION BY who ORDER BY came DESC, id) AS k FROM raw.orders",
        "SELECT id, row_number() OVER (PARTITION BY who ORDER BY came DESC NULLS FIRST, id) AS k FROM raw.orders"),
    "limit in a subquery": (
        "SELECT COUNT(*) AS n, MIN(id) AS i FROM (SELECT id FROM raw.orders ORDER BY came DESC, id LIMIT 40) AS t",
        "SELECT count(*) AS n, min(id) AS i FROM (SELECT id FROM raw.orders ORDER BY came DESC NULLS FIRST, id LIMIT 40) t"),
    "quoted names": ('SELECT o."id" AS "Nº", o.price AS "a b" FROM raw."orders" o', None),
}


def plain(rows):
    def value(v):
        if isinstance(v, (Decimal, float)):
            return round(float(v), 6)
        return v
    return sorted(tuple(value(v) for v in r) for r in rows) if rows else []


def key(row):
    return tuple((v is not None, str(v)) for v in row)


@pytest.mark.parametrize("form", FORMS)
def test_form_equals_duckdb(spark, tables, form):
    text, oracle = FORMS[form]
    given, con = tables
    df = bind_sql(spark, text, given)
    cur = con.execute(oracle or text)
    names = [d[0] for d in cur.description]
    assert df.columns == names

    def norm(rows):
        return sorted((tuple(round(float(v), 6) if isinstance(v, (Decimal, float)) else v for v in r) for r in rows), key=key)
    got, want = norm(df.collect()), norm(cur.fetchall())
    assert len(got) > 0 and got == want


def one(spark, expression):
    return bind_sql(spark, f"SELECT {expression} AS x", {}).first()["x"]


def test_bare_numeric_never_rounds(spark):
    assert one(spark, "ROUND(1.567::numeric, 2)") == Decimal("1.57")
    assert one(spark, "1.23456789012345678901234::numeric") == Decimal("1.23456789012345678901234")
    assert one(spark, "CAST('1.005' AS numeric)") == Decimal("1.005")
    assert one(spark, "ROUND('2.345'::decimal, 2)") == Decimal("2.35")
    assert one(spark, "ROUND((-2.345)::numeric, 2)") == Decimal("-2.35")
    assert one(spark, "2.5::numeric(4,1)") == Decimal("2.5")
    # a share at a tie, which doubles miss: 57 / 2000 * 100 = 2.85
    assert one(spark, "ROUND(57::numeric / 2000 * 100, 1)") == Decimal("2.9")
    # products keep all their digits
    assert one(spark, "'0.00000001'::numeric * '0.5'::numeric") == Decimal("0.000000005")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|OVERFLOW"):
        one(spark, "'12345678901234567'::numeric")


def test_intervals_are_exact(spark):
    start, end = "'2017-10-14 23:59:59.000001'::timestamp", "'2018-02-20 00:00:00'::timestamp"
    seconds = (dt.datetime(2018, 2, 20) - dt.datetime(2017, 10, 14, 23, 59, 59, 1)).total_seconds()
    for zone in ("UTC", "America/Sao_Paulo"):  # a summer-time change lies between
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert float(one(spark, f"EXTRACT(EPOCH FROM ({end} - {start}))")) == seconds
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert float(one(spark, f"EXTRACT(EPOCH FROM ({start} - {end}))")) == -seconds
    assert one(spark, "EXTRACT(ISODOW FROM DATE '2018-01-07')") == 7
    assert one(spark, "DATE_TRUNC('month', '2018-01-31 10:00:00'::timestamp)") == dt.datetime(2018, 1, 1)


@pytest.mark.parametrize("text", [
    "x::timestamptz", "x::timestamp with time zone", "CAST(x AS timestamp with time zone)", "x::timestamp(3)",
    "EXTRACT(DOW FROM x)", "'1 day'::interval"])
def test_what_would_change_is_refused(text):
    with pytest.raises(UnsupportedSql):
        to_spark(f"SELECT {text} FROM raw.orders")


def test_epoch_of_a_timestamp_is_refused(spark, tables):
    with pytest.raises(Exception, match="DATATYPE_MISMATCH|cannot cast"):
        bind_sql(spark, "SELECT EXTRACT(EPOCH FROM bought) AS s FROM raw.orders", tables[0])


@pytest.mark.parametrize("text", [
    "SELECT '::numeric raw.orders ORDER BY x' AS t -- raw.orders::numeric\n/* EXTRACT(EPOCH FROM x) */ FROM t",
    "SELECT a AS text, (SELECT 1 AS numeric) AS int FROM t", "SELECT x.raw.y, t.raw FROM t",
    "SELECT percentile_cont(0.5) WITHIN GROUP (ORDER BY x) FROM t", "SELECT \"text\" FROM t"])
def test_other_text_stays_as_it_is(text):
    assert to_spark(text, lambda n: "TABLE_" + n) == text


def test_sql_text_gives_what_the_built_in_kpis_give(spark):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    t = E._prepared(spark, SF_SMALL)
    late = "came > promised"
    days = "EXTRACT(EPOCH FROM (came - promised)) / 86400"
    text = f"""
      WITH d AS (SELECT customer_state AS estado, order_delivered_customer_date::timestamp AS came,
                        order_estimated_delivery_date::timestamp AS promised
                 FROM raw.orders JOIN raw.customers USING (customer_id)
                 WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL)
      SELECT estado, COUNT(*) AS total_pedidos, COUNT(*) FILTER (WHERE came <= promised) AS pedidos_no_prazo,
             COUNT(*) FILTER (WHERE {late}) AS pedidos_atrasados,
             ROUND(COUNT(*) FILTER (WHERE came <= promised)::numeric / COUNT(*) * 100, 2) AS otd_pct,
             ROUND(AVG(CASE WHEN {late} THEN {days} END)::numeric, 1) AS atraso_medio_dias,
             ROUND(MAX(CASE WHEN {late} THEN {days} END)::numeric, 1) AS pior_atraso_dias
      FROM d GROUP BY estado ORDER BY otd_pct DESC"""
    assert plain(bind_sql(spark, text, t).collect()) == plain(otd.build(t).collect())
    label = "CASE payment_type WHEN 'credit_card' THEN 'Cartão de Crédito' WHEN 'boleto' THEN 'Boleto' " \
            "WHEN 'voucher' THEN 'Voucher' WHEN 'debit_card' THEN 'Cartão de Débito' ELSE payment_type END"
    several = "FILTER (WHERE payment_installments > 1)"
    text = f"""
      SELECT {label} AS tipo_pagamento, COUNT(*) AS total_transacoes, ROUND(SUM(payment_value)::numeric, 2) AS valor_total,
             ROUND(AVG(payment_value)::numeric, 2) AS ticket_medio,
             ROUND(AVG(payment_installments) {several}::numeric, 1) AS parcelas_medias,
             COUNT(*) {several} AS transacoes_parceladas,
             ROUND(COUNT(*) {several}::numeric / COUNT(*) * 100, 1) AS pct_parcelado
      FROM raw.order_payments WHERE payment_type <> 'not_defined' GROUP BY 1 ORDER BY 2 DESC"""
    got, want = bind_sql(spark, text, t), payments.build(t)
    assert got.columns == want.columns
    assert sorted(plain(got.collect()), key=key) == sorted(plain(want.collect()), key=key)


def test_folder_of_files_becomes_kpi_tables(spark, tmp_path):
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    reg = Registry().register_sql_folder(SQL_FOLDER)
    assert reg.names() == ["revenue_by_month", "review_by_delay_day", "transit_by_state"]
    (tmp_path / "b.sql").write_text("SELECT COUNT(*)::numeric / 3 AS third FROM raw.orders;\n", encoding="utf-8")
    (tmp_path / "a.sql").write_text("SELECT bought::timestamptz FROM raw.orders", encoding="utf-8")
    (tmp_path / "notes.txt").write_text("SELECT", encoding="utf-8")
    reg.register_sql_folder(str(tmp_path))
    rep = run_kpis(spark, reg, tables=dict(E._prepared(spark, SF_SMALL)), out_db="an_sql_files")
    assert set(rep.written) == {"revenue_by_month", "review_by_delay_day", "transit_by_state", "b"}
    assert set(rep.failed) == {"a"} and "timestamptz" in rep.failed["a"]
    assert spark.table("an_sql_files.revenue_by_month").schema["month"].dataType.typeName() == "timestamp_ntz"
