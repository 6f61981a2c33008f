"""Column functions for verdict merging and matrix cell texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def merged_verdict(extractor: str | Column, validator: str | Column) -> Column:
    """C11: validator Yes -> Yes; validator No -> No; validator missing and
    extractor known -> No; both missing -> null."""
    e, v = _c(extractor), _c(validator)
    return (
        F.when(v == "Yes", F.lit("Yes"))
        .when(v == "No", F.lit("No"))
        .when(e.isNotNull(), F.lit("No"))
        .otherwise(F.lit(None).cast("string"))
    )


def merged_severity(validator: str | Column, v_sev: str | Column, e_sev: str | Column) -> Column:
    """C11: validator-confirmed rows take the validator's severity, falling
    back to the extractor's; every other row keeps the extractor's."""
    return F.when(_c(validator) == "Yes", F.coalesce(_c(v_sev), _c(e_sev))).otherwise(_c(e_sev))


def format_status(status: str | Column, severity: str | Column, missing: str | None = None) -> Column:
    """``Yes (Lvl s)`` when severity is known and not N/A, ``Yes``,
    ``No``; anything else becomes ``missing`` (null in stage 2, "No" in
    the prior-event stage)."""
    s, sev = _c(status), _c(severity)
    fallback = F.lit(missing) if missing is not None else F.lit(None).cast("string")
    out = F.when(
        (s == "Yes") & sev.isNotNull() & (sev != "N/A"), F.concat(F.lit("Yes (Lvl "), sev, F.lit(")"))
    ).when(s == "Yes", F.lit("Yes"))
    if missing is None:
        out = out.when(s == "No", F.lit("No"))
    return out.otherwise(fallback)


def status_of(counts: dict[str, Column]) -> Column:
    """The first status, in the given order, that something was counted
    for; null without any."""
    return F.coalesce(*(F.when(n > 0, F.lit(status)) for status, n in counts.items()))


def is_positive(cell: str | Column) -> Column:
    """A matrix cell counts as positive when it starts with Yes."""
    return _c(cell).startswith("Yes")
