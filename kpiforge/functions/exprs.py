"""Column expressions shared by the KPI builders. All JVM-side, no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Labels that appear verbatim in the KPI outputs.
# Delay bands, in their presentation order.
BAND_ON_TIME = "No prazo"
BAND_LIGHT = "Atraso leve (1-3 dias)"
BAND_MODERATE = "Atraso moderado (4-7 dias)"
BAND_SEVERE = "Atraso grave (8+ dias)"
BAND_LABELS = (BAND_ON_TIME, BAND_LIGHT, BAND_MODERATE, BAND_SEVERE)
# Payment type code -> display label; other codes pass through unchanged.
PAYMENT_LABELS = {
    "credit_card": "Cartão de Crédito",
    "boleto": "Boleto",
    "voucher": "Voucher",
    "debit_card": "Cartão de Débito",
}
EXCLUDED_PAYMENT_TYPE = "not_defined"
DELIVERED = "delivered"
OTHER_CATEGORY = "other"
# ---------------------------------------------------------------------------

US_PER_HOUR = 3_600_000_000.0
US_PER_DAY = 86_400_000_000.0
LIGHT_DELAY_US = 3 * 86_400_000_000
MODERATE_DELAY_US = 7 * 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rnd(x, n: int) -> Column:
    """Round half away from zero to ``n`` decimals, as SQL ROUND(numeric, n).

    The value is first fixed to 10 decimals so that two engines whose doubles
    differ only in the last bits (summation order) round identically."""
    return F.round(_c(x).cast("decimal(38,10)"), n).cast("double")


def safe_div(num, den) -> Column:
    """num / den in double; null when den is 0 or null (SQL NULLIF guard)."""
    return _c(num).cast("double") / F.nullif(_c(den).cast("double"), F.lit(0.0))


def pct(num, den, n: int) -> Column:
    """Share num/den in percent, rounded like ``rnd``."""
    return rnd(safe_div(num, den) * 100.0, n)


def micros_between(end, start) -> Column:
    """Exact wall-clock difference end - start in microseconds (BIGINT)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def days(us) -> Column:
    return _c(us).cast("double") / US_PER_DAY


def hours(us) -> Column:
    return _c(us).cast("double") / US_PER_HOUR


def is_on_time(delivered="order_delivered_customer_date",
               estimated="order_estimated_delivery_date") -> Column:
    """Null when either date is null: such an order is neither on time nor late."""
    return _c(delivered) <= _c(estimated)


def is_late(delivered="order_delivered_customer_date",
            estimated="order_estimated_delivery_date") -> Column:
    return _c(delivered) > _c(estimated)


def delay_band(delivered="order_delivered_customer_date",
               estimated="order_estimated_delivery_date") -> Column:
    """Band of the delivery delay in fractional days (3.5 days late is the
    4-7 band). A null estimate fails every test and lands in the last band."""
    late_us = micros_between(delivered, estimated)
    return (F.when(is_on_time(delivered, estimated), F.lit(BAND_ON_TIME))
            .when(late_us <= LIGHT_DELAY_US, F.lit(BAND_LIGHT))
            .when(late_us <= MODERATE_DELAY_US, F.lit(BAND_MODERATE))
            .otherwise(F.lit(BAND_SEVERE)))


def band_rank(band="faixa_atraso") -> Column:
    b = _c(band)
    return (F.when(b == BAND_ON_TIME, 1).when(b == BAND_LIGHT, 2)
            .when(b == BAND_MODERATE, 3).otherwise(4))


def payment_label(payment_type="payment_type") -> Column:
    pt = _c(payment_type)
    expr = None
    for code, label in PAYMENT_LABELS.items():
        expr = (F.when(pt == code, F.lit(label)) if expr is None
                else expr.when(pt == code, F.lit(label)))
    return expr.otherwise(pt)
