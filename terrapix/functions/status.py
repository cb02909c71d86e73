"""Status, label and ratio helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrapix.schema import LABEL_NAMES


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def status_group(status) -> Column:
    """success / skipped (prefix) / failed (anything else, incl. unknown)."""
    s = _c(status)
    return (F.when(s == "success", "success")
            .when(s.startswith("skipped"), "skipped")
            .otherwise("failed"))


def label_name(label) -> Column:
    """{0: Non-Crop, 1: Crop}; anything else -> null."""
    m = F.create_map(*[x for k, v in LABEL_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(label).cast("int")]


def percent(part, total) -> Column:
    """part / total * 100, 0 when total is 0."""
    part, total = _c(part).cast("double"), _c(total).cast("double")
    return F.when(total > 0, part / total * 100.0).otherwise(F.lit(0.0))


def rate(n, seconds) -> Column:
    """n / seconds, 0 when elapsed <= 0."""
    s = _c(seconds).cast("double")
    return F.when(s > 0, _c(n).cast("double") / s).otherwise(F.lit(0.0))
