"""Column-level functions (scalar expressions).  All are built-in Spark
expressions so they stay inside whole-stage codegen; none is a Python UDF.

ANSI mode is assumed: every parse uses ``try_*`` so bad input becomes null
instead of failing the job.
"""

from __future__ import annotations

from functools import reduce
from operator import add
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Fixed values that must equal the reference's (thresholds and labels).
# --------------------------------------------------------------------------
TIER_CUTS = ((0.6, "High"), (0.3, "Medium"))   # score >= 0.6 High, >= 0.3 Medium
TIER_FLOOR = "Low"
ALERT_THRESHOLD = 0.6                           # alert when alert_score > 0.6
PSI_WARN = 0.10                                 # < 0.10 stable
PSI_ALARM = 0.20                                # < 0.20 minor shift, else significant
PSI_LABELS = ("stable", "minor_shift", "significant_drift")
TIER_ACTIONS = {
    "High": "Deploy fogging crew this week",
    "Medium": "Schedule inspection - monitor closely",
    "Low": "Routine surveillance only",
}
CSI_ALARM = 0.25                                # per-feature alarm when CSI > 0.25
RECALL_TARGET = 0.80                            # threshold choice recall floor
COVERAGE_SHARE = 0.9                            # at least 90 % of them
MAX_STALE_DAYS = 21                             # freshness pass if <= 21 days
MAX_NULL_RATE = 0.05                            # null-rate pass if <= 5 %


# ---------------------------------------------------------------- parsing
def parse_yymmdd(c: ColumnOrName) -> Column:
    """YYMMDD text/number -> DATE in 2000+; a lost leading zero is restored by
    left-padding to 6 digits; anything unparsable (letters, bad calendar) is
    null."""
    n = _try_cast(F.trim(_c(c).cast("string")), "int")
    digits = F.lpad(n.cast("string"), 6, "0")
    return F.when(n.isNull() | (n < 0), F.lit(None).cast("date")).otherwise(
        F.try_to_timestamp(F.concat(F.lit("20"), digits), F.lit("yyyyMMdd")).cast("date"))


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def to_number(c: ColumnOrName, type_name: str = "double") -> Column:
    """Numeric coercion, bad values -> null (pandas ``to_numeric(errors='coerce')``)."""
    return _try_cast(F.trim(_c(c).cast("string")), type_name)


def to_date_or_null(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Date coercion, bad -> null."""
    col = _c(c)
    if fmt is None:
        return F.to_date(F.try_to_timestamp(col.cast("string")))
    return F.to_date(F.try_to_timestamp(col.cast("string"), F.lit(fmt)))


def ymd_date(y: ColumnOrName, m: ColumnOrName, d: ColumnOrName) -> Column:
    """(year, month, day) -> DATE; impossible dates -> null (``make_date``
    raises under ANSI, so format and parse instead)."""
    yi, mi, di = (_try_cast(_c(x).cast("string"), "int") for x in (y, m, d))
    txt = F.format_string("%04d-%02d-%02d", yi, mi, di)
    return F.when(yi.isNull() | mi.isNull() | di.isNull(), F.lit(None).cast("date")) \
        .otherwise(F.to_date(F.try_to_timestamp(txt, F.lit("yyyy-MM-dd"))))


def sentinel_to_null(c: ColumnOrName, value=-1) -> Column:
    """Sentinel (default -1) -> null."""
    return F.nullif(_c(c), F.lit(value))


def null_tokens(c: ColumnOrName, tokens: Iterable[str] = ("", " ")) -> Column:
    """Text cell equal to one of ``tokens`` (after trim) -> null."""
    col = _c(c)
    toks = sorted({t.strip() for t in tokens})
    return F.when(F.trim(col).isin(toks), F.lit(None).cast("string")).otherwise(col)


# ------------------------------------------------------------- text shaping
def norm(c: ColumnOrName, case: str = "lower") -> Column:
    """Trim and change case ('lower' / 'upper')."""
    t = F.trim(_c(c))
    return F.lower(t) if case == "lower" else F.upper(t)


def canonical(c: ColumnOrName) -> Column:
    """Canonical name: upper, strip, keep only word chars / spaces / hyphens,
    collapse whitespace; null stays null.  ``(?U)`` makes ``\\w`` Unicode."""
    up = F.upper(F.trim(_c(c)))
    kept = F.regexp_replace(up, r"(?U)[^\w\s\-]", "")
    return F.trim(F.regexp_replace(kept, r"(?U)\s+", " "))


def text(c: ColumnOrName) -> Column:
    """Cast to string; null stays null (the reference's 'nan' text is not kept)."""
    return _c(c).cast("string")


def clip_upper(c: ColumnOrName, hi: float) -> Column:
    """Clip above at ``hi``; null stays null (``least`` would turn null into hi)."""
    col = _c(c)
    return F.when(col > F.lit(hi), F.lit(hi)).otherwise(col)


def density(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den with zero / null denominators -> null (no +-inf)."""
    return F.try_divide(_c(num), _c(den))


def log1p_col(c: ColumnOrName) -> Column:
    return F.log1p(_c(c))


def row_sum(cols: Sequence[ColumnOrName]) -> Column:
    """Row-wise sum where null counts as 0 (pandas ``sum(axis=1)``)."""
    return reduce(add, [F.coalesce(_c(x), F.lit(0)) for x in cols])


# ------------------------------------------------------------ risk columns
def tier(c: ColumnOrName, cuts: Sequence[tuple[float, str]] = TIER_CUTS,
         floor: str = TIER_FLOOR) -> Column:
    """Score -> tier label by descending cut-offs (inclusive)."""
    col = _c(c)
    expr = None
    for cut, name in cuts:
        expr = (F.when(col >= F.lit(cut), F.lit(name)) if expr is None
                else expr.when(col >= F.lit(cut), F.lit(name)))
    return expr.otherwise(F.lit(floor))


def alert_score(score: ColumnOrName, vulnerability: ColumnOrName,
                cases: ColumnOrName, digits: int = 4) -> Column:
    """round(score * vulnerability * ln(cases + 1), digits)."""
    return F.round(_c(score) * _c(vulnerability) * F.log1p(_c(cases)), digits)


def alert_flag(c: ColumnOrName, threshold: float = ALERT_THRESHOLD) -> Column:
    """Alert when strictly above the threshold."""
    return _c(c) > F.lit(threshold)


def agree(a: ColumnOrName, b: ColumnOrName, threshold: float = 0.6) -> Column:
    """Both at/above the threshold, or both below."""
    return (_c(a) >= F.lit(threshold)) == (_c(b) >= F.lit(threshold))


def psi_flag(c: ColumnOrName, warn: float = PSI_WARN, alarm: float = PSI_ALARM) -> Column:
    col = _c(c)
    return (F.when(col < F.lit(warn), F.lit(PSI_LABELS[0]))
            .when(col < F.lit(alarm), F.lit(PSI_LABELS[1]))
            .otherwise(F.lit(PSI_LABELS[2])))


def positive_flag(c: ColumnOrName) -> Column:
    """0/1 flag from a count > 0 (null count -> 0)."""
    return (F.coalesce(_c(c), F.lit(0)) > 0).cast("int")


def action_for(c: ColumnOrName, actions: Mapping[str, str] = TIER_ACTIONS) -> Column:
    """Tier -> action text through a literal map (no join needed)."""
    m = F.create_map(*[F.lit(x) for kv in actions.items() for x in kv])
    return m[_c(c)]


def minmax_expr(c: ColumnOrName, lo: float, hi: float, eps: float = 1e-9) -> Column:
    """(x - lo) / (hi - lo + eps), with null treated as 0 first."""
    x = F.coalesce(_c(c).cast("double"), F.lit(0.0))
    return (x - F.lit(float(lo))) / (F.lit(float(hi)) - F.lit(float(lo)) + F.lit(eps))


def numpy_bin(x: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName, n: int) -> Column:
    """0-based bin of ``x`` over ``n`` equal bins on [lo, hi] with the edges
    numpy's ``linspace``/``histogram`` use: edge_i = lo + i*step, the last
    bin closed on the right, values outside [lo, hi] -> null.  lo == hi puts
    every in-range value in the last bin."""
    xv = _c(x)
    lv = F.lit(float(lo)) if isinstance(lo, (int, float)) else _c(lo)
    hv = F.lit(float(hi)) if isinstance(hi, (int, float)) else _c(hi)
    step = (hv - lv) / F.lit(float(n))
    b0 = F.floor(F.try_divide(xv - lv, step)).cast("int")
    adj = (b0
           - F.when(lv + b0.cast("double") * step > xv, 1).otherwise(0)
           + F.when(lv + (b0 + 1).cast("double") * step <= xv, 1).otherwise(0))
    inside = (xv >= lv) & (xv <= hv)
    return (F.when(~inside | xv.isNull(), F.lit(None).cast("int"))
            .when((hv == lv) | (xv == hv), F.lit(n - 1))
            .otherwise(F.least(F.greatest(adj, F.lit(0)), F.lit(n - 1))))


# ------------------------------------------------------------ extensions
def week_harmonics(c: ColumnOrName, period: float = 52.0) -> tuple[Column, Column]:
    """sin / cos of 2*pi*weekofyear/period."""
    w = F.weekofyear(_c(c)).cast("double")
    ang = F.lit(2 * 3.141592653589793) * w / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def conjunctive_alert(score: ColumnOrName, vulnerability: ColumnOrName, count: ColumnOrName,
                      t_score: float, t_vul: float, n_min: int) -> Column:
    """score > t_score AND vulnerability > t_vul AND count >= n_min."""
    return (_c(score) > F.lit(t_score)) & (_c(vulnerability) > F.lit(t_vul)) & (_c(count) >= F.lit(n_min))
