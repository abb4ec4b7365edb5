from kpiforge.functions.exprs import (  # noqa: F401
    BAND_LABELS, PAYMENT_LABELS, band_rank, days, delay_band, hours, is_late,
    is_on_time, micros_between, payment_label, pct, rnd, safe_div,
)
from kpiforge.functions.display import (  # noqa: F401
    category_label, month_label, pct_label, python_title,
)
