"""URL parts as column expressions (text rules of the macro library, not
``parse_url``, which rejects scheme-less text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def url_host(c) -> Column:
    """Strip android-app://, http://, https://; cut at the first '/' then '?'."""
    s = _c(c)
    for pre in ("android-app://", "http://", "https://"):
        s = F.replace(s, F.lit(pre), F.lit(""))
    return F.split_part(F.split_part(s, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(c) -> Column:
    """Text after the first '/' (or from the '?' when there is no slash; the
    whole text when neither), cut at '?'."""
    s = F.replace(F.replace(_c(c), F.lit("http://"), F.lit("")), F.lit("https://"), F.lit(""))
    pos = F.coalesce(F.nullif(F.position(F.lit("/"), s), F.lit(0)), F.position(F.lit("?"), s) - 1)
    return F.split_part(F.right(s, F.length(s) - pos), F.lit("?"), F.lit(1))


def url_parameter(c, name: str) -> Column:
    """Value after ``name=`` up to '&'; '' -> null (also matches inside longer
    parameter names, as the macro does)."""
    v = F.split_part(F.split_part(_c(c), F.lit(f"{name}="), F.lit(2)), F.lit("&"), F.lit(1))
    return F.nullif(v, F.lit(""))
