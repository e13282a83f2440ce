"""Column helpers used across the relations; each takes and returns Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Business zone and the laptop id rule.
BUSINESS_TZ = "Asia/Ho_Chi_Minh"
LAPTOP_ID_PATTERN = r"^[0-9]{1,10}\z"
LAPTOP_ID_MAX = 2_147_483_647

# What a UTF-8 database locale counts as white space: ASCII plus the breaking Unicode spaces.
_SPACES = r"[\s\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]+"

_RATIO_INPUT = T.DecimalType(18, 4)


def business_date(ts: Column) -> Column:
    """Calendar day in the business zone of a UTC instant (session zone must be UTC)."""
    return F.to_date(F.from_utc_timestamp(ts, BUSINESS_TZ))


def business_month(ts: Column) -> Column:
    return F.trunc(business_date(ts), "MM")


# Fixed value: instants count from the year 2000 in the source dialect, and are rounded there.
_SINCE_2000 = 946_684_800


def epoch_to_timestamp(seconds: Column) -> Column:
    """The instant of epoch seconds, rounded half to even to whole microseconds from 2000 on; NULL unless finite."""
    micros = F.rint((seconds.cast("double") - F.lit(float(_SINCE_2000))) * F.lit(1e6)).try_cast("bigint")
    return F.timestamp_micros(micros + F.lit(_SINCE_2000 * 1_000_000))


def clean_text(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACES, " "))


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def safe_divide(numerator: Column, denominator: Column, places: int = 2) -> Column:
    """Rounded decimal quotient; NULL where the denominator is missing or zero."""
    divisor = F.nullif(denominator.cast(_RATIO_INPUT), F.lit(0).cast(_RATIO_INPUT))
    return F.round(numerator.cast(_RATIO_INPUT) / divisor, places)


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole over counts; NULL where the whole is missing or zero."""
    hundredfold = part.cast("decimal(19,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(hundredfold / F.nullif(whole.cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)")), places)


def valid_laptop_id(text: Column) -> Column:
    """The id as text where it is a positive 32-bit integer, else NULL."""
    in_range = F.coalesce(text.try_cast("bigint").between(1, LAPTOP_ID_MAX), F.lit(False))
    return F.when(text.rlike(LAPTOP_ID_PATTERN) & in_range, text)


def laptop_id_number(text: Column) -> Column:
    # try_cast: the optimiser may evaluate the cast before a caller's null filter.
    return text.try_cast("int")


def numeric_label(value: Column, suffix: str = "", decimals: int = 1) -> Column:
    """Thousands-separated label, 'N/A' for NULL or NaN."""
    number = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(F.concat(F.format_number(number, decimals), F.lit(suffix)), F.lit("N/A"))


def fingerprint(*columns: Column) -> Column:
    """64 bits over the values, to compare two versions of one row without moving them.

    NULL flags are hashed too: the hash skips NULLs, so without them values could trade places unseen.
    """
    return F.xxhash64(*(part for column in columns for part in (column, column.isNull())))


def contains_literal(text: Column, query: str) -> Column:
    """Case-insensitive substring test; the query is plain text, NULL never matches."""
    return F.coalesce(F.contains(F.lower(text), F.lower(F.lit(query))), F.lit(False))


# JSON as the source dialect reads it: no single quotes. Of repeated keys the last one counts.
_STRICT_JSON = {"allowSingleQuotes": "false"}


def json_fields(text: Column, keys: tuple[str, ...]) -> Column:
    """The values of some keys as text, from one pass over the JSON."""
    return F.from_json(text, T.StructType([T.StructField(key, T.StringType()) for key in keys]), _STRICT_JSON)


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value; NULL stays NULL.

    The parser ignores what follows a value. Inside braces, and inside brackets, it has to read on to the end, and
    no text can close both.
    """
    shape = T.StructType([T.StructField("v", T.StringType()), T.StructField("_bad", T.StringType())])
    options = {**_STRICT_JSON, "columnNameOfCorruptRecord": "_bad"}

    def reads(opening: str, closing: str) -> Column:
        return F.from_json(F.concat(F.lit(opening), text, F.lit(closing)), shape, options)["_bad"].isNull()

    return F.when(text.isNotNull(), reads('{"v":', "}") & reads('{"v":[', "]}"))


def _json_scalar(value: Column) -> Column:
    # There is no scalar to_json, so wrap in a one-element array and take off the brackets.
    return F.regexp_extract(F.to_json(F.array(value)), r"(?s)^\[(.*)\]$", 1)


def canonical_json(value: Column, dtype: T.DataType) -> Column:
    """JSON text of a nested value with sorted keys and ', ' / ': ' separators."""
    if isinstance(dtype, T.StructType):
        members = [
            F.concat(F.lit(f'"{field.name}": '), _json_member(value[field.name], field.dataType))
            for field in sorted(dtype.fields, key=lambda field: field.name)
        ]
        text = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: _json_member(item, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.array_sort(F.map_keys(value)),
            lambda key: F.concat(
                _json_scalar(key.cast("string")), F.lit(": "), _json_member(F.element_at(value, key), dtype.valueType)
            ),
        )
        text = F.concat(F.lit("{"), F.array_join(entries, ", "), F.lit("}"))
    else:
        text = _json_scalar(value)
    return F.when(value.isNotNull(), text)


def _json_member(value: Column, dtype: T.DataType) -> Column:
    return F.coalesce(canonical_json(value, dtype), F.lit("null"))
