"""Text rules shared by training and scoring (so both see identical features)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config

# Fixed value: the whitespace set a Python ``str.strip()`` removes (Spark's ``trim`` only
# removes spaces, so routing trims this explicit set).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
                 "\u2028\u2029\u202f\u205f\u3000")


def strip_py_whitespace(c: Column) -> Column:
    return F.btrim(c, F.lit(PY_WHITESPACE))


def route_segment(platform: Column | None) -> Column:
    """``landing`` iff the trimmed, lower-cased platform equals ``landing``; else ``main``.

    NULL, blank or an absent column route to ``main``.
    """
    if platform is None:
        return F.lit(config.MAIN)
    norm = F.lower(strip_py_whitespace(platform.cast("string")))
    return F.when(norm == F.lit(config.LANDING), F.lit(config.LANDING)).otherwise(F.lit(config.MAIN))


def page_path(page_name: Column | None) -> Column:
    """The page label itself when it is a non-empty string, else NULL (never parsed from a URL)."""
    if page_name is None:
        return F.lit(None).cast("string")
    return F.nullif(page_name.cast("string"), F.lit(""))


def utm_campaign(page_location: Column | None) -> Column:
    """First ``utm_campaign`` query value (no decoding); NULL when absent or empty input.

    ``regexp_extract`` yields '' on no match; the group needs ≥1 character, so mapping ''
    to NULL loses nothing.
    """
    if page_location is None:
        return F.lit(None).cast("string")
    return F.nullif(F.regexp_extract(page_location.cast("string"), config.UTM_CAMPAIGN_PATTERN, 1), F.lit(""))
