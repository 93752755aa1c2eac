"""Column expressions shared by readers, joins and reports.

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import HEADER_MARKER

BAD_ROW_MODES = ("fail", "drop", "quarantine")
_DATE, _TIME = "^(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}", "[0-9]{2}:[0-9]{2}:[0-9]{2}"
_PLAIN_TS = {"yyyy-MM-dd HH:mm:ss": f"{_DATE} {_TIME}\\z", "yyyy-MM-dd'T'HH:mm:ss": f"{_DATE}T{_TIME}\\z"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_at(parts: Column, position: int, strict: bool = True) -> Column:
    """0-based (or negative, from the end) element of a split line, trimmed."""
    idx = position + 1 if position >= 0 else position
    get = F.element_at if strict else F.try_element_at
    return F.trim(get(parts, F.lit(idx)))


def is_header(c) -> Column:
    """Header lines carry the word ``timestamp`` in their time field (any case)."""
    return F.lower(_c(c)).contains(HEADER_MARKER)


def is_blank(c) -> Column:
    return F.length(F.trim(_c(c))) == 0


def to_double(c, mode: str = "fail") -> Column:
    """String -> double.  ``fail`` raises on text that is not a number."""
    c = _c(c)
    parsed = c.try_cast("double")
    if mode == "fail":
        return F.when(parsed.isNull() & c.isNotNull(),
                      F.raise_error(F.concat(F.lit("not a number: "), c))).otherwise(parsed)
    return parsed


def to_int(c, mode: str = "fail", type_name: str = "int") -> Column:
    c = _c(c)
    parsed = c.try_cast(type_name)
    if mode == "fail":
        return F.when(parsed.isNull() & c.isNotNull(),
                      F.raise_error(F.concat(F.lit("not an integer: "), c))).otherwise(parsed)
    return parsed


def to_ts(c, fmt: str, mode: str = "fail") -> Column:
    """String -> TIMESTAMP_NTZ with a datetime pattern.

    The valid/invalid decision uses ``try_to_timestamp``; the value itself is
    parsed straight to NTZ so no session time zone is involved.
    """
    c = _c(c)
    ok = F.try_to_timestamp(c, F.lit(fmt)).isNotNull()
    value = F.when(ok, F.to_timestamp_ntz(c, F.lit(fmt)))
    if mode == "fail":
        value = F.when(ok | c.isNull(), value).otherwise(
            F.raise_error(F.concat(F.lit(f"not a timestamp ({fmt}): "), c)))
    if fmt not in _PLAIN_TS:
        return value
    # text of just these digits means the same to a cast, which takes far less time than a pattern; all else goes by the pattern
    return F.coalesce(F.when(c.rlike(_PLAIN_TS[fmt]), c.try_cast("timestamp_ntz")), value)


def parse(c, type_name: str, mode: str = "fail") -> Column:
    if type_name == "double":
        return to_double(c, mode)
    if type_name in ("int", "long"):
        return to_int(c, mode, type_name)
    if type_name == "string":
        return _c(c)
    raise ValueError(f"unsupported field type {type_name!r}")


def micros_between(start, end) -> Column:
    """Signed microseconds from ``start`` to ``end`` (NTZ, no time zone)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_as_instant(c) -> Column:
    """NTZ wall clock -> TIMESTAMP instant with the same digits in UTC,
    independent of the session time zone (for windows and watermarks)."""
    return F.timestamp_micros(micros_between(F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), c))


def instant_as_ntz(c) -> Column:
    """Inverse of :func:`ntz_as_instant`."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def seconds_between(start, end) -> Column:
    return micros_between(start, end) / F.lit(1_000_000.0)


def weekday_flags(ts, names: list[str]) -> list[Column]:
    """One 0/1 int column per weekday, Monday first."""
    wd = F.weekday(_c(ts))  # Monday = 0
    return [(wd == i).cast("int").alias(n) for i, n in enumerate(names)]


def fixed10(c) -> Column:
    """``%10f`` rendering of a number."""
    return F.format_string("%10f", _c(c))


def entity_from_path(pattern: str = r"(\d+)\.csv") -> Column:
    """First match of ``pattern`` in the source file path (kept as text);
    null when the path does not match, so such files pair with nothing."""
    path = F.col("_metadata.file_path")
    return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, 1))
