"""Episode metrics, histogram moments, correlation and OLS plans
(E3, D2, B10, E12-E15).

The episode table follows the reference flow: rating metrics per (source,
episode) from ordered scenes (here: per user from ``events`` in time order,
two sources), histogram metrics per episode from vote counts (star =
``props.k % 10 + 1``), joined, plus season / premiere / finale controls.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from moodframe.functions.fields import SEASON_LENGTHS, episode_controls, episode_id_build
from moodframe.operators import metrics as mt
from moodframe.operators import stats as st
from moodframe.plans.registry import plan
from moodframe.plans.tables import table

RATING_COLS = ["funny_mean", "funny_var", "funny_change", "sad_mean", "sad_var", "sad_change"]
HIST_COLS = ["imdb_rating_mean", "imdb_rating_variance", "imdb_rating_share_1", "imdb_rating_share_10"]
METRIC_COLS = RATING_COLS + HIST_COLS
SEASON_CASE = " ".join(f"WHEN {s} THEN {n}" for s, n in SEASON_LENGTHS.items())


def _r(c, places=6):
    return F.round(F.col(c), places).alias(c)


def event_histogram(spark, sf_dir, key="user_id"):
    e = table(spark, sf_dir, "events")
    star = (F.get_json_object("props", "$.k").cast("long") % 10 + 1).cast("int")
    return e.select(key, star.alias("star")).groupBy(key, "star").agg(F.count(F.lit(1)).alias("votes"))


HIST_SQL = """
hist AS (
  SELECT {key}, CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 + 1 AS INTEGER) AS star,
         count(*) AS votes
  FROM events GROUP BY ALL
),
hmean AS (SELECT {key}, sum(star * votes) / sum(votes) AS m FROM hist GROUP BY {key}),
hm AS (
  SELECT h.{key},
         sum(h.star * h.votes) / sum(h.votes) AS imdb_rating_mean,
         sum(h.votes * (h.star - hmean.m) * (h.star - hmean.m)) / sum(h.votes) AS imdb_rating_variance,
         sum(CASE WHEN h.star = 1 THEN h.votes ELSE 0 END) / sum(h.votes) AS imdb_rating_share_1,
         sum(CASE WHEN h.star = 10 THEN h.votes ELSE 0 END) / sum(h.votes) AS imdb_rating_share_10
  FROM hist h JOIN hmean USING ({key}) GROUP BY h.{key}
)"""


@plan("histogram_metrics", "WITH " + HIST_SQL.format(key="event_type") + """
SELECT event_type, round(imdb_rating_mean, 6) AS imdb_rating_mean,
       round(imdb_rating_variance, 6) AS imdb_rating_variance,
       round(imdb_rating_share_1, 6) AS imdb_rating_share_1,
       round(imdb_rating_share_10, 6) AS imdb_rating_share_10
FROM hm
""")
def histogram_metrics(spark, sf_dir):
    h = mt.histogram_metrics(event_histogram(spark, sf_dir, "event_type"), ["event_type"])
    return h.select("event_type", *[_r(c) for c in HIST_COLS])


def rating_sources(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    labels = e.select("user_id", "ts", (F.col("event_id") % 7).cast("int").alias("funny"),
                      (F.floor("value").cast("long") % 6).cast("int").alias("sad"))
    model = e.select("user_id", "ts",
                     ((F.col("event_id") + F.col("user_id")) % 6).cast("int").alias("predicted_funny"),
                     (F.floor(F.col("value") * 10).cast("long") % 6).cast("int").alias("predicted_sad"))
    return mt.union_sources({"labels": labels, "model": model})


SOURCES_SQL = """
u AS (
  SELECT 'labels' AS source, user_id, ts, CAST(event_id % 7 AS INTEGER) AS funny,
         CAST(CAST(floor(value) AS BIGINT) % 6 AS INTEGER) AS sad FROM events
  UNION ALL
  SELECT 'model', user_id, ts, CAST((event_id + user_id) % 6 AS INTEGER),
         CAST(CAST(floor(value * 10) AS BIGINT) % 6 AS INTEGER) FROM events
),
flagged AS (SELECT *, (funny BETWEEN 1 AND 5 AND sad BETWEEN 1 AND 5) AS ok FROM u),
lagged AS (SELECT *, lag(funny) OVER w AS pf, lag(sad) OVER w AS ps, lag(ok) OVER w AS pok
           FROM flagged WINDOW w AS (PARTITION BY source, user_id ORDER BY ts)),
rm AS (
  SELECT source, user_id,
    avg(funny) AS funny_mean, var_samp(funny) AS funny_var,
    avg(CASE WHEN pok THEN abs(funny - pf) END) AS funny_change,
    avg(sad) AS sad_mean, var_samp(sad) AS sad_var,
    avg(CASE WHEN pok THEN abs(sad - ps) END) AS sad_change
  FROM lagged WHERE ok GROUP BY source, user_id
)"""

METRICS_SQL = "WITH " + SOURCES_SQL + "," + HIST_SQL.format(key="user_id") + """,
em AS (
  SELECT rm.source, printf('%d_%02d', rm.user_id % 6 + 1, rm.user_id // 6 + 1) AS episode_id,
         rm.funny_mean, rm.funny_var, rm.funny_change, rm.sad_mean, rm.sad_var, rm.sad_change,
         hm.imdb_rating_mean, hm.imdb_rating_variance, hm.imdb_rating_share_1, hm.imdb_rating_share_10,
         CAST(rm.user_id % 6 + 1 AS INTEGER) AS season,
         CAST(rm.user_id // 6 + 1 = 1 AS INTEGER) AS is_premiere,
         CAST(coalesce(rm.user_id // 6 + 1 =
              CASE rm.user_id % 6 + 1 """ + SEASON_CASE + """ END, false) AS INTEGER) AS is_finale
  FROM rm JOIN hm USING (user_id)
)"""


def episode_metrics(spark, sf_dir):
    """One row per (source, episode): six rating metrics, four histogram
    metrics and the controls."""
    rm = mt.episode_rating_metrics(rating_sources(spark, sf_dir), ["source", "user_id"], "ts")
    hm = mt.histogram_metrics(event_histogram(spark, sf_dir), ["user_id"])
    joined, _missing = mt.attach_histogram_metrics(rm, hm, ["user_id"])
    season = (F.col("user_id") % 6 + 1).cast("int")
    ep = (F.floor(F.col("user_id") / 6) + 1).cast("int")
    joined = joined.withColumn("episode_id", episode_id_build(season, ep)).drop("user_id")
    return episode_controls(joined, "episode_id")


@plan("episode_metrics", METRICS_SQL + """
SELECT source, episode_id, season, is_premiere, is_finale,
""" + ", ".join(f"round({c}, 6) AS {c}" for c in METRIC_COLS) + " FROM em")
def episode_metrics_plan(spark, sf_dir):
    m = episode_metrics(spark, sf_dir)
    return m.select("source", "episode_id", "season", "is_premiere", "is_finale", *[_r(c) for c in METRIC_COLS])


@plan("attach_histogram_metrics", "WITH " + SOURCES_SQL + "," + HIST_SQL.format(key="user_id") + """
SELECT rm.source, rm.user_id, round(rm.funny_mean, 6) AS funny_mean,
       round(hm.imdb_rating_mean, 6) AS imdb_rating_mean, false AS missing
FROM rm JOIN hm USING (user_id)
""")
def attach_histogram_metrics(spark, sf_dir):
    rm = mt.episode_rating_metrics(rating_sources(spark, sf_dir), ["source", "user_id"], "ts")
    hm = mt.histogram_metrics(event_histogram(spark, sf_dir), ["user_id"])
    joined, missing = mt.attach_histogram_metrics(rm, hm, ["user_id"])
    out = joined.select("source", "user_id", _r("funny_mean"), _r("imdb_rating_mean"), F.lit(False).alias("missing"))
    miss = missing.select(F.lit(None).cast("string").alias("source"), "user_id",
                          F.lit(None).cast("double").alias("funny_mean"),
                          F.lit(None).cast("double").alias("imdb_rating_mean"), F.lit(True).alias("missing"))
    return out.unionByName(miss)


@plan("episode_controls", """
SELECT o_orderkey, CAST(year(o_orderdate) - 1991 AS INTEGER) AS season,
       CAST(day(o_orderdate) = 1 AS INTEGER) AS is_premiere,
       CAST(coalesce(day(o_orderdate) = CASE year(o_orderdate) - 1991 """ + SEASON_CASE + """ END, false) AS INTEGER) AS is_finale
FROM orders
""")
def episode_controls_plan(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.format_string("%d_%02d", F.year("o_orderdate") - 1991,
                                      F.dayofmonth("o_orderdate")).alias("episode_id"))
    return episode_controls(o, "episode_id").select("o_orderkey", "season", "is_premiere", "is_finale")


# E12 -------------------------------------------------------------------------------
LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _corr_sql(src: str, cols, keys: str | None) -> str:
    parts = []
    for a in cols:
        for b in cols:
            k = f"{keys}, " if keys else ""
            g = f" GROUP BY {keys}" if keys else ""
            parts.append(f"SELECT {k}'{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM {src}{g}")
    return "\nUNION ALL\n".join(parts)


@plan("correlation_matrix", _corr_sql("lineitem", LI_COLS, None))
def correlation_matrix(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return st.correlation_matrix(li, LI_COLS).select("col_a", "col_b", _r("corr"))


@plan("episode_correlations", METRICS_SQL + "\n" + _corr_sql("em", METRIC_COLS, "source"))
def episode_correlations(spark, sf_dir):
    m = episode_metrics(spark, sf_dir)
    return st.correlation_matrix(m, METRIC_COLS, keys=["source"]).select("source", "col_a", "col_b", _r("corr"))


# E13 / E14 on lineitem (closed forms in SQL) ------------------------------------------
OLS_SPEC = st.FitSpec("l_quantity", ("l_discount", "l_tax"))

OLS_SQL = """
WITH d AS (SELECT l_quantity AS y, l_discount AS x1, l_tax AS x2 FROM lineitem),
m AS (
  SELECT count(*) AS n, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2,
         covar_pop(x1, x1) * count(*) AS s11, covar_pop(x1, x2) * count(*) AS s12,
         covar_pop(x2, x2) * count(*) AS s22, covar_pop(x1, y) * count(*) AS s1y,
         covar_pop(x2, y) * count(*) AS s2y, covar_pop(y, y) * count(*) AS syy
  FROM d
),
b AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM m),
c AS (SELECT *, (s22 * s1y - s12 * s2y) / det AS b1, (s11 * s2y - s12 * s1y) / det AS b2 FROM b),
e AS (SELECT *, my - b1 * m1 - b2 * m2 AS b0, syy - b1 * s1y - b2 * s2y AS ssr FROM c),
f AS (SELECT *, ssr / (n - 3) AS s2, 1 - ssr / syy AS r2 FROM e)"""


@plan("ols_fit", OLS_SQL + """
SELECT 'Intercept' AS term, round(b0, 6) AS coef,
       round(sqrt(s2 * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / det)), 6) AS std_err
FROM f
UNION ALL SELECT 'l_discount', round(b1, 6), round(sqrt(s2 * s22 / det), 6) FROM f
UNION ALL SELECT 'l_tax', round(b2, 6), round(sqrt(s2 * s11 / det), 6) FROM f
""")
def ols_fit(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    coefs, _ = st.ols_fit(li, [OLS_SPEC], with_tests=False)
    return coefs.select("term", _r("coef"), _r("std_err"))


@plan("ols_stats", OLS_SQL + """
SELECT CAST(n AS BIGINT) AS nobs, CAST(n - 3 AS BIGINT) AS df_resid, round(r2, 6) AS r2,
       round(1 - (n - 1) / (n - 3) * (1 - r2), 6) AS adj_r2,
       round((r2 / 2) / ((1 - r2) / (n - 3)), 6) AS f_stat,
       round(-n / 2.0 * (ln(2 * pi()) + ln(ssr / n) + 1), 6) AS log_lik,
       round(n * (ln(2 * pi()) + ln(ssr / n) + 1) + 6, 6) AS aic,
       round(n * (ln(2 * pi()) + ln(ssr / n) + 1) + ln(n) * 3, 6) AS bic
FROM f
""")
def ols_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    _, fits = st.ols_fit(li, [OLS_SPEC], with_tests=False)
    return fits.select("nobs", "df_resid", _r("r2"), _r("adj_r2"), _r("f_stat"), F.round("log_lik", 6).alias("log_lik"),
                       _r("aic"), _r("bic"))


LI_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@plan("ols_diagnostics", OLS_SQL + """,
r AS (SELECT d2.*, d2.y - f.b0 - f.b1 * d2.x1 - f.b2 * d2.x2 AS res
      FROM (SELECT l_quantity AS y, l_discount AS x1, l_tax AS x2, """ + ", ".join(LI_ORDER) + """ FROM lineitem) d2,
           f),
mo AS (SELECT count(*) AS n, avg(res) AS mr FROM r),
cm AS (SELECT avg(power(res - mr, 2)) AS m2, avg(power(res - mr, 3)) AS m3, avg(power(res - mr, 4)) AS m4,
              max(n) AS n FROM r, mo),
dw AS (SELECT sum(dd * dd) AS num FROM (SELECT res - lag(res) OVER (ORDER BY """ + ", ".join(LI_ORDER) + """) AS dd FROM r)),
ee AS (SELECT sum(res * res) AS den FROM r)
SELECT CAST(n AS BIGINT) AS nobs, round(m3 / power(m2, 1.5), 6) AS skew, round(m4 / (m2 * m2), 6) AS kurtosis,
       round(n / 6.0 * (power(m3 / power(m2, 1.5), 2) + power(m4 / (m2 * m2) - 3, 2) / 4), 6) AS jarque_bera,
       round(num / den, 6) AS durbin_watson
FROM cm, dw, ee
""")
def ols_diagnostics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    coefs, _ = st.ols_fit(li, [OLS_SPEC], with_tests=False)
    d = st.ols_diagnostics(li, [OLS_SPEC], coefs, order=LI_ORDER)
    return d.select("nobs", _r("skew"), _r("kurtosis"), _r("jarque_bera"), _r("durbin_watson"))


@plan("ols_tests")
def ols_tests(spark, sf_dir):
    """p values, confidence intervals, F p value, omnibus and condition
    number (distribution tails have no SQL form: rows-only)."""
    li = table(spark, sf_dir, "lineitem")
    coefs, fits = st.ols_fit(li, [OLS_SPEC])
    diag = st.with_omnibus(st.ols_diagnostics(li, [OLS_SPEC], coefs, order=LI_ORDER))
    c = coefs.select("fit", "term", "p_value", "ci_low", "ci_high")
    f = fits.select("fit", "f_pvalue", "cond_no")
    d = diag.select("fit", "jb_pvalue", "omnibus", "omnibus_pvalue")
    return c.join(f, "fit").join(d, "fit")


# E15 ---------------------------------------------------------------------------------
GRID_TARGETS = ["imdb_rating_mean", "imdb_rating_variance", "imdb_rating_share_1", "imdb_rating_share_10"]
GRID_FEATURES = [["funny_mean", "sad_mean"], ["funny_var", "sad_var"], ["funny_change", "sad_change"]]
GRID_CONTROLS = ["is_premiere", "is_finale", "season"]


@plan("ols_grid")
def ols_grid(spark, sf_dir):
    """4 targets x 3 feature pairs x controls on/off = 24 fits per source,
    all from one moment aggregate (rows-only; tested against numpy)."""
    m = episode_metrics(spark, sf_dir)
    specs = st.ols_grid(GRID_TARGETS, GRID_FEATURES, GRID_CONTROLS)
    coefs, fits = st.ols_fit(m, specs, keys=["source"])
    return coefs.join(fits.select("source", "fit", "nobs", "r2", "adj_r2", "f_stat", "aic", "bic"), ["source", "fit"])


def _pairs_sql() -> str:
    """Every two-feature fit of the grid in closed form."""
    parts = []
    for t in GRID_TARGETS:
        for a, b in GRID_FEATURES:
            parts.append(f"""
SELECT source, '{t} ~ {a} + {b}' AS fit, count(*) AS n, var_pop({a}) AS saa, var_pop({b}) AS sbb, covar_pop({a}, {b}) AS sab,
       covar_pop({a}, {t}) AS sat, covar_pop({b}, {t}) AS sbt, var_pop({t}) AS stt, avg({a}) AS ma, avg({b}) AS mb, avg({t}) AS mt
FROM em WHERE {t} IS NOT NULL AND {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY source""")
    return " UNION ALL ".join(parts)


@plan("ols_grid_pairs", METRICS_SQL + ", g AS (" + _pairs_sql() + """),
c AS (SELECT *, (sbb * sat - sab * sbt) / (saa * sbb - sab * sab) AS b1, (saa * sbt - sab * sat) / (saa * sbb - sab * sab) AS b2
      FROM g WHERE n > 3 AND saa * sbb - sab * sab > 1e-9 * saa * sbb AND stt > 0)
SELECT source, fit, n AS nobs, round(mt - b1 * ma - b2 * mb, 6) AS b0, round(b1, 6) AS b1, round(b2, 6) AS b2,
       round((b1 * sat + b2 * sbt) / stt, 6) AS r2
FROM c
""")
def ols_grid_pairs(spark, sf_dir):
    m = episode_metrics(spark, sf_dir)
    specs = st.ols_grid(GRID_TARGETS, GRID_FEATURES)
    coefs, fits = st.ols_fit(m, specs, keys=["source"], with_tests=False)
    first = {spec.label: spec.features[0] for spec in specs}
    which = F.when(F.col("term") == "Intercept", "b0").when(
        F.col("term").isin(*set(first.values())), "b1").otherwise("b2")
    wide = coefs.withColumn("slot", which).groupBy("source", "fit").agg(*(
        F.max(F.when(F.col("slot") == s, F.col("coef"))).alias(s) for s in ("b0", "b1", "b2")))
    good = fits.filter("not singular and df_resid > 0 and r2 is not null").select("source", "fit", "nobs", "r2")
    return wide.join(good, ["source", "fit"]).select("source", "fit", "nobs", _r("b0"), _r("b1"), _r("b2"), _r("r2"))
