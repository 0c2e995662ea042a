"""Column scaling."""

from __future__ import annotations

from siftwork.catalog.base import FEATURES_SQL, features, query, r6_sql, rounded
from siftwork.operators.scale import FeatureScaler
from siftwork.sources.shared import stage

SCALED = ["qty", "avg_price", "c_acctbal", "same", "price_ratio"]
SOURCE = f"""{FEATURES_SQL}, src AS (SELECT code, qty, avg_price, c_acctbal, 2e0 AS same,
  CASE WHEN avg_disc = 0 OR avg_disc IS NULL THEN 0e0 ELSE avg_price / avg_disc END AS price_ratio FROM features)"""


def scaling_input(spark, sf_dir):
    return stage(
        features(spark, sf_dir).selectExpr(
            "code",
            "qty",
            "avg_price",
            "c_acctbal",
            "2e0 AS same",
            "CASE WHEN avg_disc = 0 OR avg_disc IS NULL THEN 0e0 ELSE avg_price / avg_disc END AS price_ratio",
        )
    )


def _sql(shift: str, divisor: str) -> str:
    stats = ", ".join(f"{shift.format(c=c)} AS a_{c}, {divisor.format(c=c)} AS b_{c}" for c in SCALED)
    cells = ", ".join(f"{r6_sql(f'({c} - a_{c}) / CASE WHEN b_{c} = 0 THEN 1e0 ELSE b_{c} END')} AS {c}" for c in SCALED)
    return f"WITH {SOURCE}, s AS (SELECT {stats} FROM src) SELECT code, {cells} FROM src, s"


def _scaled(spark, sf_dir, method, **options):
    df = scaling_input(spark, sf_dir)
    return rounded(FeatureScaler(method, **options).fit(df).transform(df), *SCALED)


@query("h1_standard", _sql("AVG({c})", "STDDEV_POP({c})"))
def standard(spark, sf_dir):
    return _scaled(spark, sf_dir, "standard")


@query("h2_minmax", _sql("MIN({c})", "MAX({c}) - MIN({c})"))
def minmax(spark, sf_dir):
    return _scaled(spark, sf_dir, "minmax")


@query("h3_robust", _sql("MEDIAN({c})", "QUANTILE_CONT({c}, 0.75) - QUANTILE_CONT({c}, 0.25)"))
def robust(spark, sf_dir):
    return _scaled(spark, sf_dir, "robust")


# Population skewness written out as moments around the mean.
_MOMENTS = ", ".join(f"AVG({c}) AS m_{c}" for c in SCALED)
_SKEWS = ", ".join(f"AVG(POWER({c} - m_{c}, 3)) / NULLIF(POWER(STDDEV_POP({c}), 3), 0) AS k_{c}" for c in SCALED)
_BASE = ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}, MIN({c}) AS lo_{c}, MAX({c}) AS hi_{c}" for c in SCALED)
_AUTO = ", ".join(
    r6_sql(
        f"CASE WHEN ABS(k_{c}) > 1 THEN ({c} - lo_{c}) / NULLIF(hi_{c} - lo_{c}, 0) "
        f"WHEN s_{c} = 0 THEN {c} - m_{c} ELSE ({c} - m_{c}) / s_{c} END"
    )
    + f" AS {c}"
    for c in SCALED
)


@query(
    "h4_auto_scale",
    f"""WITH {SOURCE}, mm AS (SELECT {_MOMENTS} FROM src), k AS (SELECT {_SKEWS} FROM src, mm),
       b AS (SELECT {_BASE} FROM src) SELECT code, {_AUTO} FROM src, k, b""",
)
def auto_scale(spark, sf_dir):
    return _scaled(spark, sf_dir, "auto")


_LOGGED = "LN(1 + GREATEST(price_ratio, 0e0))"


@query(
    "h5_log_standard",
    f"""WITH {SOURCE}, l AS (SELECT code, c_acctbal, {_LOGGED} AS price_ratio FROM src),
       s AS (SELECT AVG(c_acctbal) AS m1, STDDEV_POP(c_acctbal) AS s1, AVG(price_ratio) AS m2, STDDEV_POP(price_ratio) AS s2 FROM l)
       SELECT code, {r6_sql("(c_acctbal - m1) / s1")} AS c_acctbal, {r6_sql("(price_ratio - m2) / s2")} AS price_ratio
       FROM l, s""",
)
def log_standard(spark, sf_dir):
    df = scaling_input(spark, sf_dir).select("code", "c_acctbal", "price_ratio")
    model = FeatureScaler("standard", log_columns=["price_ratio"]).fit(df)
    return rounded(model.transform(df), "c_acctbal", "price_ratio")


_KINDS = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, CASE WHEN ABS(k_{c}) > 1 THEN 'minmax' ELSE 'standard' END AS kind, FALSE AS logged,
    {r6_sql(f"CASE WHEN ABS(k_{c}) > 1 THEN lo_{c} ELSE m_{c} END")} AS shift,
    {r6_sql(f"CASE WHEN ABS(k_{c}) > 1 THEN hi_{c} - lo_{c} WHEN s_{c} = 0 THEN 1e0 ELSE s_{c} END")} AS divisor FROM k, b"""
    for c in SCALED
)


@query(
    "h6_scaler_parameters",
    f"""WITH {SOURCE}, mm AS (SELECT {_MOMENTS} FROM src), k AS (SELECT {_SKEWS} FROM src, mm),
       b AS (SELECT {_BASE} FROM src) {_KINDS}""",
)
def scaler_parameters(spark, sf_dir):
    """Which scaler each column got and its fitted numbers."""
    model = FeatureScaler("auto").fit(scaling_input(spark, sf_dir))
    return rounded(model.parameters(spark), "shift", "divisor")
