"""Column helpers: the reference's scalar utilities re-expressed as Spark
expressions so they run inside whole-stage codegen, never as Python rows.

Every function takes and returns ``Column`` objects (strings are column
names unless noted) and is null-safe in the way the reference's helper is.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# date/time text formats used by the reference's helpers.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
TIME_MINUTE_FORMAT = "yyyyMMddHHmm"
BAG_DELIMITER = r"\|"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --- strings -------------------------------------------------------------

def is_empty(s) -> Column:
    """NULL or '' (ST5)."""
    s = _c(s)
    return s.isNull() | (s == F.lit(""))


def is_not_empty(s) -> Column:
    return ~is_empty(s)


def trim_comma(s) -> Column:
    """Drop one leading and one trailing comma (ST3)."""
    return F.regexp_replace(_c(s), r"^,|,$", "")


def fulfill(s) -> Column:
    """Keep a 2-character text, otherwise prefix one '0' (ST4)."""
    s = _c(s)
    return F.when(F.length(s) == 2, s).otherwise(F.concat(F.lit("0"), s))


def _bag_text(bag, delimiter: str) -> Column:
    """The bag with '|' between pieces and no trailing empty pieces."""
    b = _c(bag)
    if delimiter != BAG_DELIMITER:
        b = F.array_join(F.split(b, delimiter), "|")
    return F.regexp_replace(b, r"\|+$", "")


def _quote(field: str) -> str:
    return re.escape(field)


def bag_get(bag, field: str, delimiter: str = BAG_DELIMITER) -> Column:
    """Value of ``field`` in a ``k=v|k=v`` bag (ST1).

    The first piece ``name=value`` whose name matches wins; pieces with an
    empty value or with more than one value (``k=``, ``k==v``, ``k=a=b``)
    are skipped, trailing '=' are ignored. No match -> NULL.
    One anchored regex: linear in the bag and inside whole-stage codegen.
    """
    # A leading '|' lets the pattern start with a literal (an alternation
    # such as (?:^|\|) defeats the regex engine's prefix scan, ~5x slower).
    pattern = rf"\|{_quote(field)}=([^=|]+)=*(?=\||$)"
    text = _c(bag) if delimiter == BAG_DELIMITER else F.array_join(F.split(_c(bag), delimiter), "|")
    # element 0 of all matches: evaluated once, NULL when there is none
    return F.get(F.regexp_extract_all(F.concat(F.lit("|"), text), F.lit(pattern), 1), 0)


def bag_set(bag, field: str, value, delimiter: str = BAG_DELIMITER) -> Column:
    """Replace the first piece named ``field`` by ``field=value`` (ST2).

    A piece's name is the text before its first '='. Absent field -> bag
    unchanged; trailing empty pieces are dropped and pieces are joined with
    ``|`` whatever the split delimiter.
    """
    # lazily skip whole pieces until the first one named `field`
    pattern = rf"^((?:[^|]*\|)*?){_quote(field)}(?:=[^|]*)?(?=\||$)"
    literal = F.regexp_replace(_lit(value).cast("string"), r"([\\$])", r"\\$1")
    replacement = F.concat(F.lit("$1" + field.replace("\\", "\\\\").replace("$", "\\$") + "="), literal)
    return F.regexp_replace(_bag_text(bag, delimiter), pattern, replacement)


def bag_of(**fields) -> Column:
    """Build a ``k=v|k=v`` bag from columns, in argument order.

    A NULL value renders as an empty value (``k=``), which ``bag_get`` reads
    back as NULL.
    """
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(_c(v).cast("string"), F.lit("")))
             for k, v in fields.items()]
    return F.concat_ws("|", *parts)


def concat_long_string(id_col, name_col, delimiter: str = ";") -> Column:
    """``id + delimiter + name`` (SC1); NULL when either side is NULL."""
    return F.concat(_c(id_col).cast("string"), F.lit(delimiter), _c(name_col))


def split_list(s, sep: str = ",") -> Column:
    """Comma list -> array with Java ``String.split`` rules: trailing empty
    pieces are dropped (``"x,"`` -> [x], ``","`` -> []), but ``""`` -> [""].
    NULL stays NULL."""
    c = _c(s)
    q = re.escape(sep)
    stripped = F.regexp_replace(c, f"({q})+$", "")
    return (F.when(c == F.lit(""), F.array(F.lit("")))
            .when(stripped == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q)))


# --- JSON ----------------------------------------------------------------

def json_field(js, field: str) -> Column:
    """Top-level JSON field by name as text (SC2); missing or malformed -> NULL."""
    return F.get_json_object(_c(js), f"$.{field}")


def json_array_first_field(js, field: str) -> Column:
    """Field of element 0 of a JSON array of objects (SC3)."""
    arr = F.from_json(_c(js), "array<map<string,string>>")
    return F.try_element_at(F.get(arr, 0), F.lit(field))


def task_param(js, field: str) -> Column:
    """First value of the JSON array stored under ``field`` (SC4).

    ``{"startDate":["2024-01-01"]}`` -> '2024-01-01'; missing field, empty
    array or bad JSON -> NULL.
    """
    m = F.from_json(_c(js), "map<string,array<string>>")
    return F.get(F.try_element_at(m, F.lit(field)), 0)


def task_params_bag(js, fields: list[str]) -> Column:
    """The filter-parameter bag of a task: ``field=<first JSON value>`` for
    each of ``fields`` present in the task's JSON, joined with '|' (FIL7)."""
    known = F.from_json(_c(js), "struct<" + ",".join(f"{f}:array<string>" for f in fields) + ">")
    pieces = [F.concat(F.lit(f + "="), F.get(known[f], 0)) for f in fields]
    return F.concat_ws("|", *pieces)   # concat_ws skips the NULL (absent) pieces


# --- dates and times -----------------------------------------------------

def parse_time(s) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> timestamp; bad text -> NULL (DT3)."""
    return F.try_to_timestamp(_c(s), F.lit(TIME_FORMAT))


def parse_date_key(s) -> Column:
    """'yyyyMMdd' text -> timestamp; bad text -> NULL (DT2)."""
    return F.try_to_timestamp(_c(s), F.lit(DATE_KEY_FORMAT))


def format_time(ts) -> Column:
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date(ts) -> Column:
    """DT1."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_date_key(ts) -> Column:
    """DT2."""
    return F.date_format(_c(ts), DATE_KEY_FORMAT)


def date_hour(ts) -> Column:
    """'yyyy-MM-dd_HH' (DT6)."""
    return F.date_format(_c(ts), DATE_HOUR_FORMAT)


def format_time_minute(ts) -> Column:
    """'yyyyMMddHHmm' (DT7)."""
    return F.date_format(_c(ts), TIME_MINUTE_FORMAT)


def time_before(t1, t2) -> Column:
    """t1 strictly before t2, both 'yyyy-MM-dd HH:mm:ss'; parse error -> false (DT4)."""
    return F.coalesce(parse_time(t1) < parse_time(t2), F.lit(False))


def time_after(t1, t2) -> Column:
    """DT4."""
    return F.coalesce(parse_time(t1) > parse_time(t2), F.lit(False))


def time_minus_seconds(t1, t2) -> Column:
    """Whole seconds t1 - t2 of two time texts; parse error -> 0 (DT5)."""
    diff = F.unix_timestamp(parse_time(t1)) - F.unix_timestamp(parse_time(t2))
    return F.coalesce(diff, F.lit(0).cast("bigint"))


def today() -> Column:
    """DT8: today as 'yyyy-MM-dd' (a job default, never inside oracle queries)."""
    return F.date_format(F.current_date(), DATE_FORMAT)


def yesterday() -> Column:
    """DT8."""
    return F.date_format(F.date_sub(F.current_date(), 1), DATE_FORMAT)


def epoch_millis(ts) -> Column:
    """Epoch milliseconds of a timestamp (either flavour), truncating micros."""
    return F.unix_millis(_c(ts).cast("timestamp"))


def from_epoch_millis(ms) -> Column:
    """DT9: epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_c(ms))


# --- numbers -------------------------------------------------------------

def ratio_2dp(n, total) -> Column:
    """n/total rounded HALF_UP to 2 decimals, in integer arithmetic (MA1).

    Both engines agree on this recipe (floating ``round`` does not); an empty
    denominator gives NULL.
    """
    n, total = _c(n).cast("bigint"), _c(total).cast("bigint")
    num = n * 200 + total
    den = F.nullif(total * 2, F.lit(0))
    # exact integer quotient, then one division by 100
    return ((num - F.pmod(num, den)) / den).cast("double") / F.lit(100.0)


def round_half_up(x, scale: int) -> Column:
    """formatDouble(x, scale) through Spark's decimal rounding."""
    return F.round(_c(x), scale)
