"""Column expressions: class rules, right-closed bands, guarded arithmetic.

All are native Catalyst expressions (whole-stage codegen); no Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxpop.schema import (BANDS, DETRATOR, NEUTRO, PROMOTOR, RISK_ACTIONS, RISK_BANDS,
                           RISK_POINT_RULES, SEM_CLASSE)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- P1 / P2 / P3: NPS class rules ------------------------------------------

def nps_class(score="nps_score", rule: str = "floor") -> Column:
    """``floor``: floor(s) >= 9 Promotor, >= 7 Neutro, else Detrator (NULL in, NULL out).
    ``select``: s <= 6 Detrator, 6 < s < 9 Neutro, s >= 9 Promotor, else 'Sem classificação'.
    ``cut``: (-1,6] Detrator, (6,8] Neutro, (8,10] Promotor, NULL outside."""
    s = _c(score)
    if rule == "floor":
        f = F.floor(s)
        return (F.when(f >= 9, PROMOTOR).when(f >= 7, NEUTRO)
                .when(s.isNotNull(), DETRATOR))
    if rule == "select":
        return (F.when(s <= 6, DETRATOR).when((s > 6) & (s < 9), NEUTRO)
                .when(s >= 9, PROMOTOR).otherwise(SEM_CLASSE))
    if rule == "cut":
        return (F.when((s > -1) & (s <= 6), DETRATOR).when((s > 6) & (s <= 8), NEUTRO)
                .when((s > 8) & (s <= 10), PROMOTOR))
    raise ValueError(f"unknown class rule {rule!r}")


def is_detractor(score="nps_score", rule: str = "floor") -> Column:
    """0/1 detractor flag under a class rule; a missing score gives 0."""
    if rule == "select":
        return F.coalesce((_c(score) <= 6).cast("int"), F.lit(0))
    return F.coalesce((nps_class(score, rule) == DETRATOR).cast("int"), F.lit(0))


# --- P5 / P6: right-closed bands ---------------------------------------------

def band_id(x, edges, include_lowest: bool = False) -> Column:
    """Ordinal of the right-closed band (e[i], e[i+1]] holding x; NULL outside.
    A last edge of None leaves the top band open."""
    x = _c(x)
    expr = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        cond = (x >= lo) if (i == 0 and include_lowest) else (x > lo)
        if hi is not None:
            cond = cond & (x <= hi)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def band_label(x, edges, labels, include_lowest: bool = False) -> Column:
    bid = band_id(x, edges, include_lowest)
    return F.element_at(F.array(*[F.lit(lb) for lb in labels]), bid + 1)


def named_band(name: str, include_lowest: bool | None = None):
    """(column name, band_id expr, label expr) for a band in ``schema.BANDS``."""
    col, edges, labels = BANDS[name]
    lowest = (name == "delay_band_logistics") if include_lowest is None else include_lowest
    return col, band_id(col, edges, lowest), band_label(col, edges, labels, lowest)


# --- P9 / P10: guarded ratios ------------------------------------------------

def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (ANSI mode would raise)."""
    return F.try_divide(_c(a), _c(b))


def ratio_or_zero(a, b) -> Column:
    """A / b with 0 when b is 0 or NULL."""
    return F.coalesce(safe_div(a, F.nullif(_c(b), F.lit(0))), F.lit(0.0))


def ratio_if_positive(a, b) -> Column:
    """P10: a / b only when b > 0, else NULL."""
    return F.when(_c(b) > 0, _c(a) / _c(b))


# --- P12 / P13 / P16: rule score, action, model risk band --------------------

def risk_points() -> Column:
    total = None
    for col, threshold in RISK_POINT_RULES:
        term = (F.col(col) >= threshold).cast("int")
        total = term if total is None else total + term
    return total


def risk_action(points="score_risco") -> Column:
    p = _c(points)
    expr = None
    for i, label in enumerate(RISK_ACTIONS):
        expr = F.when(p == i, label) if expr is None else expr.when(p == i, label)
    return expr


def risk_band(score="risk_score") -> Column:
    s = _c(score)
    expr = None
    for label, lower in RISK_BANDS:
        if lower is None:
            expr = expr.when(s.isNotNull(), label)
        else:
            expr = F.when(s >= lower, label) if expr is None else expr.when(s >= lower, label)
    return expr


def risk_band_order(band="risk_band") -> Column:
    b = _c(band)
    expr = None
    for i, (label, _) in enumerate(RISK_BANDS):
        expr = F.when(b == label, i) if expr is None else expr.when(b == label, i)
    return expr


# --- P19 / P20 / P21: labels and verdicts ------------------------------------

def currency_brl(x) -> Column:
    return F.concat(F.lit("R$ "), F.format_number(_c(x), 2))


def nps_verdict(nps) -> Column:
    n = _c(nps)
    return F.when(n > 50, "Excelente (>50)").when(n > 0, "Bom (>0)").otherwise("Crítico (<=0)")


def mae_verdict(mae) -> Column:
    m = _c(mae)
    return F.when(m < 1.5, "aceitável").when(m < 2.5, "razoável").otherwise("alto")


def auc_verdict(auc) -> Column:
    a = _c(auc)
    return F.when(a > 0.9, "excelente").when(a > 0.8, "bom").otherwise("razoável")


def significance(p, alpha: float = 0.05) -> Column:
    return (F.when(_c(p) < alpha, "rejeitamos a hipótese nula")
            .when(_c(p).isNotNull(), "não rejeitamos a hipótese nula"))


def spread_verdict(spread, limit: float = 0.5) -> Column:
    return F.when(_c(spread) < limit, "variação baixa").when(_c(spread).isNotNull(), "variação relevante")


def correlation_direction(r) -> Column:
    r = _c(r)
    return F.when(r > 0, "positiva").when(r < 0, "negativa").otherwise("nula")


# --- safe statistics -----------------------------------------------------------

def safe_corr(x, y) -> Column:
    """Pearson r over pairwise-complete rows; NULL (not an error) for a
    constant column."""
    x, y = _c(x), _c(y)
    xx = F.when(y.isNotNull(), x)
    yy = F.when(x.isNotNull(), y)
    return F.covar_pop(xx, yy) / F.nullif(F.stddev_pop(xx) * F.stddev_pop(yy), F.lit(0.0))
