"""Column functions shared by the operators. All are built-in expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(a, b) -> Column:
    """NULL instead of an error when the divisor is zero."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def clean_double(x) -> Column:
    """Missing means NULL only: NaN becomes NULL."""
    c = _c(x).cast("double")
    return F.when(~F.isnan(c), c)


def is_finite(x) -> Column:
    c = _c(x).cast("double")
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def safe_double(x) -> Column:
    """Text to double; bad text and the literal "nan" give NULL."""
    c = F.trim(_c(x)).try_cast("double")
    return F.when(~F.isnan(c), c)


def parse_ts(x, fmt: str | None = None) -> Column:
    return F.try_to_timestamp(_c(x), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(x))


def mid(bid, ask) -> Column:
    return (_c(bid) + _c(ask)) / F.lit(2.0)


def spread(bid, ask) -> Column:
    return _c(ask) - _c(bid)


def year_start(year) -> Column:
    return F.make_date(_c(year), F.lit(1), F.lit(1))


def entity_code(name) -> Column:
    return F.upper(F.substring(_c(name), 1, 3))


def slug(name) -> Column:
    return F.regexp_replace(F.lower(_c(name)), " ", "_")


def safe_name(name) -> Column:
    return F.regexp_replace(_c(name), r"[^\p{L}\p{N}]", "_")


def base_name(path) -> Column:
    return F.element_at(F.split(_c(path), "/"), -1)


def extension(path) -> Column:
    """Lower-case extension without the dot; empty when there is none."""
    return F.lower(F.regexp_extract(base_name(path), r"\.([^.]+)$", 1))


def stem(path) -> Column:
    return F.regexp_replace(base_name(path), r"\.[^.]+$", "")


def relative_path(path, root: str) -> Column:
    """Path below ``root``, whatever URI scheme the reader put in front."""
    plain = root.split("://")[-1] if "://" in root else root.removeprefix("file:")
    return F.element_at(F.split(_c(path), plain.rstrip("/") + "/", 2), -1)


def percent(part, whole, digits: int = 1) -> Column:
    return F.round(ratio(part, whole) * 100, digits)


def label_below(x, *steps: tuple[float, str], otherwise: str) -> Column:
    """First label whose limit the value stays below; NULL stays NULL."""
    c = _c(x)
    out = F.when(c.isNull(), None)
    for limit, name in steps:
        out = out.when(c < limit, name)
    return out.otherwise(otherwise)


def as_text(x) -> Column:
    return _c(x).cast("string")


def chi2_tail_even(x, df: int) -> Column:
    """Upper tail of chi-square for an even number of degrees of freedom, closed form."""
    if df % 2 or df <= 0:
        raise ValueError("closed form needs an even df")
    h = _c(x) / 2
    # exp(-h) * h^k / k! as one exponential per term, so that large h does not overflow.
    terms = F.exp(-h)
    log_fact = 0.0
    for k in range(1, df // 2):
        log_fact += math.log(k)
        terms = terms + F.when(h > 0, F.exp(-h + k * F.ln(h) - log_fact)).otherwise(0.0)
    return F.when(_c(x).isNotNull(), terms)
