"""Column expressions for SAP/OData source quirks.

Every function takes and returns a ``Column`` built from
``pyspark.sql.functions`` only, so it stays inside whole-stage codegen;
none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values that must equal the reference for identical results.
# Regex patterns, date formats and sentinel codes used by the rules.
ODATA_DATE_RE = r"^/Date\(([0-9]+)\)/$"          # strict form (fact rules)
ODATA_DATE_LENIENT_RE = r"^/Date\((-?[0-9]+)"    # extractor form (+offset, negatives)
NUMERIC_CODE_RE = r"^0*[0-9]+$"
SAP_DATE_RE = r"^[0-9]{8}$"
CURRENCY_RE = r"^[A-Z]{3}$"
TAX_ID_RE = r"^[0-9]{11}$"
ZERO_DATE = "00000000"
UNKNOWN_DATE_KEY = -1


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- F1-F2b
def sap_alpha(c) -> Column:
    """strip leading zeros only from all-digit codes ('000' -> '')."""
    c = _c(c)
    return F.when(c.rlike(NUMERIC_CODE_RE), F.regexp_replace(c, "^0+", "")).otherwise(c)


def alpha_strip(c) -> Column:
    """strip leading zeros always; all-zero and empty become '0'."""
    c = _c(c)
    stripped = F.regexp_replace(c, "^0+", "")
    return (F.when(c.isNotNull() & (stripped == ""), F.lit("0"))
            .otherwise(F.coalesce(stripped, c)))


def alpha_lookup(c) -> Column:
    """Lookup form, strip always, all-zero becomes ''."""
    c = _c(c)
    return F.coalesce(F.regexp_replace(c, "^0+", ""), c)


# ---------------------------------------------------------------- F3-F5
def sap_date(c) -> Column:
    """yyyyMMdd text -> date; NULL, zero date, malformed, impossible -> NULL."""
    c = _c(c)
    ok = c.isNotNull() & (c != ZERO_DATE) & c.rlike(SAP_DATE_RE)
    return F.when(ok, F.try_to_date(c, "yyyyMMdd"))


def sap_amount(c, precision: int = 18, scale: int = 2) -> Column:
    """'1234.56-' -> -1234.56 as DECIMAL(p,s); unparseable -> NULL."""
    c = _c(c)
    t = f"decimal({precision},{scale})"
    neg = F.right(c, F.lit(1)) == "-"
    head = F.substring(c, F.lit(1), F.length(c) - 1)
    body = F.when(neg, -head.try_cast(t)).otherwise(c.try_cast(t))
    return body.cast(t)


def try_number(c, precision: int | None = 18, scale: int = 0) -> Column:
    """lenient number; integers when precision is None."""
    c = _c(c)
    if precision is None:
        return c.try_cast("int")
    return c.try_cast(f"decimal({precision},{scale})")


# ---------------------------------------------------------------- F6-F8
def odata_ts(c) -> Column:
    """strict ``/Date(ms)/`` (no offset, no sign) or ISO text -> timestamp.

    Milliseconds are truncated to whole seconds, as a seconds-based
    conversion does in the reference.
    """
    c = _c(c)
    ms = F.regexp_extract(c, ODATA_DATE_RE, 1).cast("bigint")
    return (F.when(c.rlike(ODATA_DATE_RE), F.timestamp_seconds(F.floor(ms / 1000)))
            .otherwise(c.try_cast("timestamp")))


def odata_to_yyyymmdd(c) -> Column:
    """extractor normalisation, ``/Date(ms[+off])/`` -> 'yyyyMMdd' in UTC.

    Accepts a sign and an offset suffix; text that does not parse is kept.
    """
    c = _c(c)
    ms = F.regexp_extract(c, ODATA_DATE_LENIENT_RE, 1)
    day = F.date_format(F.timestamp_millis(ms.cast("bigint")), "yyyyMMdd")
    return F.when(c.startswith("/Date(") & (ms != ""), day).otherwise(c)


def date_key(ts, default: int | None = UNKNOWN_DATE_KEY) -> Column:
    """F8: yyyyMMdd integer key of a date/timestamp, NULL -> default."""
    k = F.date_format(_c(ts), "yyyyMMdd").cast("int")
    return k if default is None else F.coalesce(k, F.lit(default))


# ---------------------------------------------------------------- F9-F12
def row_hash(*cols) -> Column:
    """md5 of NULL->'' values joined by '|' (NULLs keep their slot)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.md5(F.concat(*parts))


def fingerprint(c) -> Column:
    """sha2-256 of a JSON payload, NULL as ''."""
    return F.sha2(F.coalesce(_c(c), F.lit("")), 256)


JSON_OPTIONS = {"ignoreNullFields": "false",
                "timestampFormat": "yyyy-MM-dd HH:mm:ss",
                "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}


def payload(*cols) -> Column:
    """row (or the named columns) to JSON, NULL fields kept as null.

    Timestamps render as 'yyyy-MM-dd HH:mm:ss' so the text is engine-neutral.
    """
    return F.to_json(F.struct(*[_c(c) for c in cols]), JSON_OPTIONS)


def std_code(c) -> Column:
    """upper + trim."""
    return F.trim(F.upper(_c(c)))


# ---------------------------------------------------------------- F16-F18
def empty_warnings() -> Column:
    """F16: typed empty ``array<string>``."""
    return F.array().cast("array<string>")


def add_warning(arr, code: str, when: Column | None = None) -> Column:
    """F16: append a warning code (optionally only when a condition holds)."""
    arr = _c(arr)
    appended = F.array_append(arr, F.lit(code))
    return appended if when is None else F.when(when, appended).otherwise(arr)


def quarantine_key(entity, record_id, rule, raw_record) -> Column:
    """deterministic quarantine id = sha2 of the quarantine identity."""
    return F.sha2(F.concat_ws("|", _c(entity), F.coalesce(_c(record_id), F.lit("")),
                              _c(rule), fingerprint(raw_record)), 256)


def to_odata_date(ms) -> Column:
    """epoch milliseconds -> ``/Date(ms)/`` text."""
    return F.concat(F.lit("/Date("), _c(ms).cast("bigint").cast("string"), F.lit(")/"))


def epoch_ms(ts) -> Column:
    """Milliseconds since epoch of a (NTZ or LTZ) timestamp, UTC session."""
    return F.unix_millis(_c(ts).cast("timestamp"))


# ---------------------------------------------------------------- predicates
def any_changed(pairs: Iterable[tuple]) -> Column:
    """Null-safe 'some attribute differs' over (left, right) column pairs."""
    cond = None
    for a, b in pairs:
        d = ~_c(a).eqNullSafe(_c(b))
        cond = d if cond is None else (cond | d)
    return cond if cond is not None else F.lit(False)


def max_len_exceeded(c, n: int) -> Column:
    """Length with NULL read as empty string exceeds n."""
    return F.length(F.coalesce(_c(c), F.lit(""))) > n


def is_deleted(c) -> Column:
    """Rejection status trimmed equals 'C'."""
    return F.trim(F.coalesce(_c(c), F.lit(""))) == "C"


def since_days(c, as_of: str, days: int) -> Column:
    """C >= as_of - days (anchored on a parameter, not on today)."""
    return _c(c) >= F.date_sub(F.lit(as_of).cast("date"), days)


def since_months(c, as_of: str, months: int) -> Column:
    """C >= add_months(as_of, -months)."""
    return _c(c) >= F.add_months(F.lit(as_of).cast("date"), -months)


def blank(c) -> Column:
    """NULL or whitespace only."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


# ---------------------------------------------------------------- U1
SQL_FUNCTIONS = {
    "f_sap_date": (
        "d STRING", "DATE",
        "CASE WHEN d IS NULL OR d = '00000000' OR NOT d RLIKE '^[0-9]{8}$' THEN NULL "
        "ELSE try_to_date(d, 'yyyyMMdd') END"),
    "f_sap_alpha": (
        "v STRING", "STRING",
        "CASE WHEN v RLIKE '^0*[0-9]+$' THEN regexp_replace(v, '^0+', '') ELSE v END"),
    "f_sap_amount": (
        "a STRING", "DECIMAL(18,2)",
        "CAST(CASE WHEN right(a, 1) = '-' THEN -try_cast(substring(a, 1, length(a) - 1) "
        "AS DECIMAL(18,2)) ELSE try_cast(a AS DECIMAL(18,2)) END AS DECIMAL(18,2))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register the cleaning functions as SQL functions (stay in Catalyst)."""
    for name, (args, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(SQL_FUNCTIONS)
