"""NULL-strict helpers matching warehouse semantics."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_least(*cols: Column) -> Column:
    """LEAST that is NULL when any argument is NULL (Spark's ``least`` skips NULLs)."""
    cond = cols[0].isNotNull()
    for c in cols[1:]:
        cond = cond & c.isNotNull()
    return F.when(cond, F.least(*cols))


def nonempty_or_null(arr: Column) -> Column:
    """An aggregated array that collected nothing is NULL, not ``[]``."""
    return F.when(F.size(arr) > 0, arr)


def json_text_or_null(arr: Column) -> Column:
    """JSON text of an array; a NULL array renders as the text ``null``."""
    return F.coalesce(F.to_json(arr), F.lit("null"))


# Fixed value: integers outside ±2^53 are written as quoted strings in the warehouse's JSON text.
JSON_SAFE_INT = 9007199254740992


def json_int_array_text(arr: Column) -> Column:
    """JSON text of an integer array with the warehouse's rule for large integers (quoted
    beyond ±2^53); a NULL array renders as ``null``."""
    def elem(x: Column) -> Column:
        big = (x > F.lit(JSON_SAFE_INT)) | (x < F.lit(-JSON_SAFE_INT))
        return F.when(big, F.concat(F.lit('"'), x.cast("string"), F.lit('"'))).otherwise(x.cast("string"))
    body = F.concat(F.lit("["), F.array_join(F.transform(arr, elem), ","), F.lit("]"))
    return F.coalesce(body, F.lit("null"))
