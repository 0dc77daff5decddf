"""Column-level helpers (built-in Spark expressions only, so they stay in whole-stage codegen)."""

from marketlens.functions.money import avg_exact, item_value, pct, round2  # noqa: F401
from marketlens.functions.timefns import (  # noqa: F401
    avg_elapsed, calendar_days, day_name, elapsed_micros, hour_of, iso_dow, month_of, month_num, year_of,
)
from marketlens.functions.labels import category_label  # noqa: F401
