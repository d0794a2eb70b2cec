"""Scalar column expressions (X1-X17, P7).  All JVM-side, no Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for identical results.
# Ingestion days, in order (index = number of ledger rows).
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
# Upstream status that marks the end of the data.
EXHAUSTION_HTTP_STATUS = 400
# Serving-side status codes (lower-cased, trimmed input).
STATUS_CODES = {"for_sale": 0.0, "ready_to_build": 1.0, "sold": 2.0}
# Serving-side hash buckets.
CITY_BUCKETS = 10000
STATE_BUCKETS = 1000


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- P7 / X3 ---
def is_null(c: str | Column, floating: bool = True) -> Column:
    """``None`` or NaN.  ``floating=False`` for non-float columns."""
    c = col(c)
    return (c.isNull() | F.isnan(c)) if floating else c.isNull()


_NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?|nan))\s*$"


def to_double(c: str | Column) -> Column:
    """``c`` as a double where its text is a number, else null (NaN included).

    Booleans and texts that only the engine's cast reads as numbers (a type
    suffix as in '5d') are null.  The column's type is a constant of the
    plan: a numeric column is cast as it is and never printed and matched.
    """
    kind = F.typeof(col(c))
    numeric = kind.isin("tinyint", "smallint", "int", "bigint", "float", "double") | kind.startswith("decimal")
    d = F.when(numeric | col(c).cast("string").rlike(_NUMBER), col(c).try_cast("double"))
    return F.nanvl(d, F.lit(None).cast("double"))


# ------------------------------------------------------------------- X4 -----
def sold_year(c: str | Column, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """Year of a date text in the first matching format; unparseable or null -> 0.

    Accepted formats are a parameter (ISO dates by default)."""
    return F.coalesce(*[F.year(F.try_to_timestamp(col(c), F.lit(f))) for f in formats], F.lit(0))


# ---------------------------------------------------------------- X1/X2 -----
def canonical_json(cols: Sequence[str]) -> Column:
    """JSON object of ``cols`` with keys sorted, nulls kept."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(cols)]), {"ignoreNullFields": "false"})


def row_hash(cols: Sequence[str]) -> Column:
    """MD5 of the canonical record (key-order independent)."""
    return F.md5(canonical_json(cols))


def received(payload: str | Column) -> Column:
    """The whole record as received: every key and JSON type of a JSON text (VARIANT); null if it is no JSON.

    A record that names a key twice counts as no JSON."""
    return F.try_parse_json(col(payload))


def canonical_received(payload: str | Column) -> Column:
    """X2 for a record as received: keys sorted at every level, all of them kept, ``"12"`` and ``12`` apart.

    Numbers written without exponent are compared by value (``1`` is ``1.0``).
    A text that is no JSON stands for itself, so nothing is lost or merged."""
    return F.coalesce(F.to_json(received(payload)), col(payload))


def received_hash(payload: str | Column) -> Column:
    """X1 for a record as received: MD5 of its canonical text."""
    return F.md5(canonical_received(payload))


def text_hash(c: str | Column) -> Column:
    """X1 for single-text records (documents): MD5 of the UTF-8 text."""
    return F.md5(col(c))


# ------------------------------------------------------------- X5 / X6 ------
def to_utc(ts: str | Column, tz: str | Column | None = None) -> Column:
    """Naive timestamps are UTC (session zone is UTC); aware -> UTC."""
    t = col(ts).cast("timestamp")
    return t if tz is None else F.to_utc_timestamp(t, col(tz))


def iso8601(ts: str | Column) -> Column:
    """ISO-8601 text in UTC with ``+00:00`` offset, fraction only when
    non-zero (the usual ``isoformat`` shape); null-safe."""
    t = col(ts)
    whole = F.unix_micros(t) % 1000000 == 0
    return F.when(whole, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(
        F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def parse_iso8601(c: str | Column) -> Column:
    """Parse ISO-8601 text (``Z`` or offset accepted); failure -> null."""
    return F.try_to_timestamp(col(c))


# ------------------------------------------------------------ X7 / X8 -------
def relative_change(new: str | Column, hist: str | Column) -> Column:
    """|new - hist| / |hist|; null when hist is 0 or either side is missing."""
    new, hist = col(new), col(hist)
    return F.when(hist != 0, F.abs(new - hist) / F.abs(hist))


def improvement_pct(baseline: str | Column, value: str | Column) -> Column:
    """(b - v) / b; baseline 0 -> 0 when v is 0 else -inf."""
    b, v = col(baseline), col(value)
    return F.when(b == 0, F.when(v == 0, F.lit(0.0)).otherwise(F.lit(float("-inf")))).otherwise((b - v) / b)


def worsening_pct(baseline: str | Column, value: str | Column) -> Column:
    """(v - b) / b; baseline 0 -> 0 when v is 0 else +inf."""
    b, v = col(baseline), col(value)
    return F.when(b == 0, F.when(v == 0, F.lit(0.0)).otherwise(F.lit(float("inf")))).otherwise((v - b) / b)


# ------------------------------------------------------------ X9 / X10 ------
def status_code(c: str | Column) -> Column:
    """lower+trim, fixed map, else -1."""
    m = F.create_map(*[x for k, v in STATUS_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, F.lower(F.trim(col(c)))), F.lit(-1.0))


def hash_bucket(c: str | Column, n: int) -> Column:
    """lower+trim, hash into ``n`` buckets.

    Uses the first 8 hex digits of MD5 so any SQL engine can reproduce it.
    """
    h = F.conv(F.substring(F.md5(F.lower(F.trim(col(c)))), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(n)).cast("double")


# --------------------------------------------------------- X11 formatting ---
def fmt_fixed(x: str | Column, digits: int) -> Column:
    """Python ``{x:.Nf}``."""
    return F.format_string(f"%.{digits}f", col(x))


def fmt_pct(x: str | Column, digits: int) -> Column:
    """Python ``{x:.N%}``."""
    return F.concat(F.format_string(f"%.{digits}f", col(x) * 100), F.lit("%"))


def py_list(arr: str | Column) -> Column:
    """Python ``repr`` of a list of strings: ``['a', 'b']``."""
    return F.concat(F.lit("["), F.array_join(F.transform(col(arr), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


# ------------------------------------------------------- X12 / X13 ----------
def blank_to_null(c: str | Column) -> Column:
    """Null, empty or whitespace-only text (any Unicode whitespace) -> null."""
    c = col(c)
    return F.when(~F.regexp_like(c, F.lit(r"(?U)^\s*$")), c)


def derive_status(status: str | Column, error: str | Column) -> Column:
    """Explicit status wins; else 'error' when a message exists, else 'ok'.

    Returns null for a status outside {'ok','error'} (invalid, quarantined).
    """
    s, e = col(status), blank_to_null(error)
    return (F.when(s.isNull(), F.when(e.isNotNull(), F.lit("error")).otherwise(F.lit("ok")))
            .when(s.isin("ok", "error"), s))


def derive_error(status: str | Column, error: str | Column) -> Column:
    """X13: 'ok' -> null message; 'error' without message -> 'unknown error'."""
    st, e = derive_status(status, error), blank_to_null(error)
    return F.when(st == "error", F.coalesce(e, F.lit("unknown error")))


# ------------------------------------------------------- X15-X17 ------------
def status_label(trained: str | Column, promoted: str | Column) -> Column:
    """trained+promoted / trained only / not trained."""
    t, p = F.coalesce(col(trained), F.lit(False)), F.coalesce(col(promoted), F.lit(False))
    return F.when(t & p, F.lit("trained_promoted")).when(t, F.lit("trained_not_promoted")).otherwise(F.lit("skipped"))


def present_null(c: str | Column, placeholder: str = "—") -> Column:
    """Null or empty text -> placeholder."""
    return F.coalesce(F.nullif(col(c).cast("string"), F.lit("")), F.lit(placeholder))


def join_batches(arr: str | Column) -> Column:
    """Comma-joined batch numbers."""
    return F.array_join(F.transform(col(arr), lambda x: x.cast("string")), ",")
