"""Scalar column functions (all JVM-side expressions, no Python UDF).

Each function takes and returns ``Column`` so it composes inside one ``select`` and stays
inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch import schemas

MICROS_PER_SECOND = 1_000_000.0


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# X1 -----------------------------------------------------------------------------------
def trim(c: Column | str) -> Column:
    """Without white space (blank, tab, line ends, form feed) at both ends."""
    return F.btrim(col_(c), F.lit(" \t\n\x0b\f\r"))


# X2 -----------------------------------------------------------------------------------
def keyword_pattern(words: list[str]) -> str:
    """Literal alternation; the keywords contain only letters, '_' and spaces."""
    return "|".join(words)


def signature_class(sig: Column | str) -> Column:
    """Upper-case the text and return the first class whose keyword occurs in it (else 0).

    Substring semantics on purpose: 'RCE' inside 'FORCE' counts.  Null / '' -> 0.
    """
    s = F.upper(col_(sig))
    expr = F.lit(0)
    for code, words in reversed(schemas.SIGNATURE_CLASSES):
        expr = F.when(s.rlike(keyword_pattern(words)), F.lit(code)).otherwise(expr)
    return F.when(col_(sig).isNull() | (col_(sig) == ""), F.lit(0)).otherwise(expr)


# X4 / X6 / X7 / X8 -------------------------------------------------------------------
def parse_ts(s: Column | str) -> Column:
    """ISO-8601 with or without fraction and with offset (+0900, +09:00, Z) -> timestamp."""
    return _try_ts(col_(s))


def _try_ts(c: Column) -> Column:
    return c.try_cast("timestamp")


# The source's flow-time pattern: a fractional second is required; offsets +HHMM, +HH:MM, Z.
STRICT_FLOW_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{1,6}(Z|[+-][0-9]{2}:?[0-9]{2})$"


def _flow_time(c: Column | str, strict: bool) -> Column:
    c = col_(c)
    return F.when(c.rlike(STRICT_FLOW_TIME), c) if strict else c


def micros_between(start: Column | str, end: Column | str, strict: bool = False) -> Column:
    """end - start in whole microseconds; null when either side is missing or unparsable.

    ``strict`` rejects timestamps the source's fixed pattern would reject (no fraction)."""
    s, e = _flow_time(start, strict), _flow_time(end, strict)
    return F.unix_micros(_try_ts(e)) - F.unix_micros(_try_ts(s))


def duration_us_zero(start: Column | str, end: Column | str, strict: bool = False) -> Column:
    """Flow duration in microseconds, 0.0 on failure, rounded to 6 digits (batch rule)."""
    secs = micros_between(start, end, strict).cast("double") / MICROS_PER_SECOND
    return F.coalesce(F.bround(secs * MICROS_PER_SECOND, 6), F.lit(0.0))


def duration_s_zero(start: Column | str, end: Column | str, strict: bool = False) -> Column:
    return F.coalesce(micros_between(start, end, strict).cast("double") / MICROS_PER_SECOND, F.lit(0.0))


def duration_us_floor(start: Column | str, end: Column | str, strict: bool = False) -> Column:
    """Streaming rule: at least 1 microsecond; failure -> 1.0."""
    secs = micros_between(start, end, strict).cast("double") / MICROS_PER_SECOND
    return F.coalesce(F.greatest(secs * MICROS_PER_SECOND, F.lit(1.0)), F.lit(1.0))


def duration_seconds_kisti(age: Column | str, start: Column | str, end: Column | str, event_ts: Column | str) -> Column:
    """``age`` if present, else whole seconds end - (start or event timestamp), else null."""
    st = F.coalesce(col_(start), col_(event_ts))
    diff = micros_between(st, end)
    # int() of a timedelta's float seconds truncates toward zero
    whole = (diff.cast("double") / MICROS_PER_SECOND).cast("long")
    return F.coalesce(col_(age), whole)


def yyyymmddhhmmss(s: Column | str) -> Column:
    """Parse 'yyyyMMddHHmmss' text (an integer in the source); invalid -> null.

    The text carries no zone; it is read as UTC wall time (an explicit +0000), so
    differences are plain wall-clock differences whatever the session time zone (no DST
    hour appears, as with naive datetimes)."""
    txt = F.trim(col_(s).cast("string"))
    # the source parses via int(): '20170703153045.0' is accepted, '2017-07-03' is not
    txt = F.regexp_replace(txt, r"\.0*$", "")
    ok = txt.rlike(r"^[0-9]{14}$")
    return F.when(ok, F.try_to_timestamp(F.concat(txt, F.lit("+0000")), F.lit("yyyyMMddHHmmssZ")))


def seconds_between_compact(start: Column | str, end: Column | str) -> Column:
    diff = F.unix_micros(yyyymmddhhmmss(end)) - F.unix_micros(yyyymmddhhmmss(start))
    return (diff.cast("double") / MICROS_PER_SECOND).cast("long")


# X9 / X10 / X11 / X12 ------------------------------------------------------------------
def safe_div(num: Column, den: Column) -> Column:
    """num / den when den > 0 else 0.0 (ANSI-safe: the division is never evaluated at 0)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def round_half_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def pct(c: Column, digits: int = 2) -> Column:
    return F.bround(c * F.lit(100.0), digits)


# X13 / X14 / X15 / X16 / X17 / X18 / X21 ------------------------------------------------
def flag01(b: Column | str) -> Column:
    return F.coalesce(col_(b), F.lit(False)).cast("int")


def jumbo_flag(avg_size: Column) -> Column:
    return (avg_size > F.lit(1500)).cast("int")


def verdict_from_alerted(alerted: Column | str) -> Column:
    return F.when(F.coalesce(col_(alerted), F.lit(False)), F.lit(schemas.ALERT)).otherwise(F.lit(schemas.BENIGN))


def outcome(ids_verdict: Column | str, model_label: Column | str) -> Column:
    """4-way class; any model label other than BENIGN counts as an attack."""
    ids_alert = col_(ids_verdict) == F.lit(schemas.ALERT)
    model_attack = ~col_(model_label).eqNullSafe(F.lit(schemas.BENIGN))
    return (
        F.when(ids_alert & ~model_attack, F.lit(schemas.OUTCOME_IDS_ONLY))
        .when(~ids_alert & model_attack, F.lit(schemas.OUTCOME_MODEL_ONLY))
        .when(ids_alert & model_attack, F.lit(schemas.OUTCOME_BOTH))
        .otherwise(F.lit(schemas.OUTCOME_NEITHER))
    )


def max_probability(prob_vector: Column | str) -> Column:
    return F.array_max(vector_to_array(col_(prob_vector)))


def severity_or_99(sev: Column | str) -> Column:
    return F.coalesce(col_(sev).cast("int"), F.lit(99))


# X19 ---------------------------------------------------------------------------------
def clock_stamp() -> Column:
    return F.date_format(F.current_timestamp(), "HH:mm:ss")


# J8 ----------------------------------------------------------------------------------
def code_lookup(c: Column | str, mapping: dict, default) -> Column:
    """Case-sensitive literal map lookup with a default for misses and nulls."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(m[col_(c)], F.lit(default))


def proto_code(proto: Column | str) -> Column:
    return code_lookup(proto, schemas.PROTO_CODES, -1)


def direction_code(direction: Column | str) -> Column:
    return code_lookup(direction, schemas.DIRECTION_CODES, -1)


def attack_label(code: Column | str) -> Column:
    """Code -> label text; unknown code -> the code as text."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(schemas.ATTACK_LABELS.items())])
    return F.coalesce(m[col_(code)], col_(code).cast("string"))


# F4 ----------------------------------------------------------------------------------
def finite_or_null(c: Column | str) -> Column:
    c = col_(c)
    return F.when(F.isnan(c) | c.isin(float("inf"), float("-inf")), F.lit(None)).otherwise(c)
