"""Column expressions (scalar functions).

Everything here returns a ``Column`` built from Spark built-ins, so it stays
inside whole-stage codegen.  No Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vireo import config as C

# FIXED VALUES: accented Latin letters and their plain forms (NFKD base
# letter), used to fold accents inside the JVM with ``translate``.
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝºª"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyyAAAAAAEEEEIIIIOOOOOUUUUCNYoa"

# A plain decimal number as pandas/Python would parse it (Spark's cast also
# accepts suffixes like '1d' and '1f', which Python rejects).
NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c) -> Column:
    return F.translate(col_(c), ACCENTED, PLAIN)


def fold(c) -> Column:
    """lower + trim + accent fold."""
    return strip_accents(F.lower(F.trim(col_(c))))


def parse_number(c) -> Column:
    """String -> double only for plain numbers; anything else -> null."""
    c = col_(c)
    return F.when(c.rlike(NUMERIC_RE), F.trim(c).try_cast("double"))


# P5 ------------------------------------------------------------------------
def repair_serial_age(c, lo: int = 5, hi: int = 30, is_numeric: bool = False) -> Column:
    """Ages damaged by spreadsheet date serialisation.

    Numbers truncate toward zero and are kept inside ``lo..hi``; a plain
    numeric string likewise; ``1900-mm-dd`` strings give their day when it is
    inside the range; everything else is null.
    """
    c = col_(c)
    if is_numeric:
        v = F.when(c.isNotNull() & ~F.isnan(c.cast("double")), c.cast("double"))
        t = F.when(v.isNotNull(), F.when(v < 0, F.ceil(v)).otherwise(F.floor(v))).cast("bigint")
        return F.when(t.between(lo, hi), t).cast("bigint")
    s = c.cast("string")
    num = parse_number(s)
    t = F.when(num.isNotNull() & ~F.isnan(num) & (F.abs(num) < F.lit(9.2e18)),
               F.when(num < 0, F.ceil(num)).otherwise(F.floor(num))).cast("bigint")
    d = F.try_to_timestamp(s, F.lit("yyyy-MM-dd"))
    day = F.when(F.year(d) == 1900, F.dayofmonth(d))
    return F.coalesce(F.when(t.between(lo, hi), t),
                      F.when(s.rlike(r"^1900-\d{2}-\d{2}$") & day.between(lo, hi), day)).cast("bigint")


# P6 ------------------------------------------------------------------------
def standardize_category(c, rules=C.CATEGORY_RULES, null_value=C.CATEGORY_NULL,
                         other=C.CATEGORY_OTHER) -> Column:
    """Ordered, accent- and case-insensitive substring rules."""
    v = fold(c)
    expr = None
    for out, any_of, all_of in rules:
        cond = None
        for s in any_of:
            e = v.contains(s)
            cond = e if cond is None else (cond | e)
        if all_of:
            a = None
            for s in all_of:
                e = v.contains(s)
                a = e if a is None else (a & e)
            cond = a if cond is None else (cond | a)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    expr = expr.otherwise(F.lit(other))
    return F.when(col_(c).isNull(), F.lit(null_value)).otherwise(expr)


# P7 ------------------------------------------------------------------------
def binary_target(c) -> Column:
    """``< 0`` -> 1, else 0; null -> 0 (the code's rule)."""
    return F.coalesce((col_(c) < 0).cast("int"), F.lit(0))


# P13 -----------------------------------------------------------------------
def risk_label(score, threshold: float) -> Column:
    return (col_(score) >= F.lit(threshold)).cast("int")


def risk_band(score, low: float = C.BAND_LOW, high: float = C.BAND_HIGH) -> Column:
    s = col_(score)
    return (F.when(s >= high, F.lit("high")).when(s >= low, F.lit("medium"))
             .when(s.isNotNull(), F.lit("low")))


# P14 -----------------------------------------------------------------------
def value_bin(v, low: float = C.VALUE_BIN_LOW, high: float = C.VALUE_BIN_HIGH) -> Column:
    x = col_(v)
    return (F.when(x.isNull(), F.lit(None).cast("string"))
             .when(x < low, F.lit("low")).when(x < high, F.lit("medium")).otherwise(F.lit("high")))


# S5 ------------------------------------------------------------------------
def pseudonymize(c, salt: str = "") -> Column:
    """First 16 hex chars of sha256('salt:value')."""
    return F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), col_(c).cast("string")), 256), 1, 16)


# S1/S2 ---------------------------------------------------------------------
def pii_match_count(c, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(col_(c), F.lit(pattern), 0))


def pii_redact(c, patterns=C.PII_PATTERNS, replacement: str = C.REDACTED) -> Column:
    """Sequential global replacement in pattern order."""
    out = col_(c).cast("string")
    for _, p in patterns:
        out = F.regexp_replace(out, p, replacement)
    return out


def has_pii(c, patterns=C.PII_PATTERNS) -> Column:
    cond = None
    for _, p in patterns:
        e = col_(c).rlike(p)
        cond = e if cond is None else (cond | e)
    return F.coalesce(cond, F.lit(False))
