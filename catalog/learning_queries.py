"""Splits, scaling, regressors and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import r, register, rounded, rounded_sql
from catalog.state_queries import _samples, weather_model_rows
from catalog.tables import (
    LAST_TRAIN_YEAR,
    MONTH_FEATURES,
    TARGET_YEAR,
    cte,
    county_yields,
    panel,
    state_yields,
    stored_panel,
    table,
    with_ctes,
)
from cropweave import schemas
from cropweave.functions import flatten_steps
from cropweave.models import boosting, metrics, regression, reports, scaling, splits
from cropweave.operators import profiling
from cropweave.operators.ranking import leading_names, top_by_abs
from cropweave.operators.repair import fill_from_history
from cropweave.plans.sequences import pad_sequences
from cropweave.plans.state_months import state_month_dataset
from cropweave.session import materialize

LABEL = schemas.LABEL
SPLIT_SQL = f"""CASE WHEN "Year" <= {LAST_TRAIN_YEAR} THEN 'train' ELSE 'validation' END"""
DAY_COLUMNS = list(schemas.MEASURES)


def _train(df: DataFrame) -> DataFrame:
    return splits.temporal_split(df, LAST_TRAIN_YEAR)[0]


@register(
    with_ctes(
        f"""
SELECT split, COUNT(*) AS n_rows, MIN("Year") AS min_year, MAX("Year") AS max_year
FROM (SELECT "Year", {SPLIT_SQL} AS split FROM county_yields) GROUP BY 1
""",
        "county_yields",
    )
)
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_spans(splits.label_split(county_yields(spark, sf_dir), LAST_TRAIN_YEAR))


@register(
    f"""
SELECT l_orderkey, o_custkey, CASE WHEN k <= n - CEIL(0.2e0 * n) THEN 'train'
  ELSE 'validation' END AS split
FROM (
  SELECT o_orderkey AS l_orderkey, o_custkey, COUNT(*) OVER () AS n,
    row_number() OVER (ORDER BY md5('42|' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS k
  FROM orders WHERE year(o_orderdate) <= {LAST_TRAIN_YEAR})
"""
)
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly four fifths of the early orders, picked by a digest of their keys."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        F.year("o_orderdate").alias("Year"),
    )
    marked = splits.seeded_split(_train(orders), ["l_orderkey"])
    return marked.select("l_orderkey", "o_custkey", "split")


def _stats_sql(names, source: str = "panel") -> str:
    fields = ", ".join(
        f'AVG("{n}") AS "m_{n}", STDDEV_POP("{n}") AS "s_{n}", '
        f'MIN("{n}") AS "lo_{n}", MAX("{n}") AS "hi_{n}"'
        for n in names
    )
    return f"""(SELECT {fields} FROM {source} WHERE year("Date") <= {LAST_TRAIN_YEAR})"""


def _scaled_sql(names, shift: str, scale: str) -> str:
    """Each column less its shift over its scale, where a zero scale counts as one."""
    columns = []
    for n in names:
        low, width = shift.format(n=n), scale.format(n=n)
        value = f'("{n}" - {low}) / COALESCE(NULLIF({width}, 0), 1)'
        columns.append(f'{rounded_sql(value)} AS "{n}"')
    return ", ".join(columns)


_STANDARD = _scaled_sql(DAY_COLUMNS, '"m_{n}"', '"s_{n}"')
_MINMAX = _scaled_sql(DAY_COLUMNS, '"lo_{n}"', '("hi_{n}" - "lo_{n}")')


def _train_days(days: DataFrame) -> DataFrame:
    return days.filter(F.year("Date") <= LAST_TRAIN_YEAR)


@register(
    with_ctes(
        f"""
SELECT "State", "County", "Date", {_STANDARD}
FROM panel CROSS JOIN {_stats_sql(DAY_COLUMNS)}
""",
        "panel",
    )
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stored_panel(spark, sf_dir)
    return rounded(scaling.standard_scale(_train_days(days), days, DAY_COLUMNS))


@register(
    with_ctes(
        f"""
SELECT "State", "County", "Date", {_MINMAX}
FROM panel CROSS JOIN {_stats_sql(DAY_COLUMNS)}
""",
        "panel",
    )
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = stored_panel(spark, sf_dir)
    return rounded(scaling.minmax_scale(_train_days(days), days, DAY_COLUMNS))


@register(
    with_ctes(
        f"""
SELECT "State", "County", "Date", {rounded_sql("(tmin - m_tmax) / s_tmax")} AS scaled,
  {r("tmin")}
FROM panel CROSS JOIN {_stats_sql(["tmax"])}
""",
        "panel",
    )
)
def inverse_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale one column with another one's statistics and take it back again."""
    days = stored_panel(spark, sf_dir)
    train = _train_days(days)
    as_label = days.select("State", "County", "Date", F.col("tmin").alias("tmax"))
    scaled = scaling.standard_scale(train, as_label, ["tmax"])
    both = scaled.select(
        "State", "County", "Date", F.col("tmax").alias("scaled"), F.col("tmax").alias("tmin")
    )
    return rounded(scaling.inverse_scale(train, both, ["tmin"], "tmax"))


_SEQ = [f for f in schemas.SEQUENCE_FEATURES if f != "Year"]
_SEQ_STATS = ", ".join(
    f'AVG("{n}") AS "m_{n}", STDDEV_POP("{n}") AS "s_{n}"' for n in _SEQ
)
_SEQ_SCALED = _scaled_sql(_SEQ, '"m_{n}"', '"s_{n}"')


@register(
    with_ctes(
        f"""
SELECT "Year", "State", "Week" AS step, {_SEQ_SCALED}
FROM season_weeks CROSS JOIN (
  SELECT {_SEQ_STATS} FROM season_weeks WHERE "Year" < 2000)
""",
        "season_weeks",
    )
)
def sequence_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    samples = materialize(_samples(spark, sf_dir), "samples")
    train = samples.filter(F.col("Year") < 2000)
    scaled = scaling.scale_sequences(train, samples, len(schemas.SEQUENCE_FEATURES))
    steps = scaled.select("Year", "State", F.posexplode("features").alias("_pos", "_step"))
    return rounded(
        steps.select(
            "Year",
            "State",
            (F.col("_pos") + 1).alias("step"),
            *[F.col("_step")[i].alias(name) for i, name in enumerate(_SEQ)],
        )
    )


# --- least squares -----------------------------------------------------------
# The SQL fits by projecting out one feature after the other: e_k is feature k less
# its projections on e_1..e_{k-1}, and the prediction is the mean label plus the
# projection of the label on every e_k.
OLS_FEATURES = ["Year", "JunePrecipShortfall", "JulyTemp", "JulyPrecip", "JulyPrecipSq"]


def _projection(x: str, k: int) -> str:
    """Slope of x on e_k; 0 for a feature that is constant in training."""
    return f"COALESCE(SUM({x} * e_{k}) / NULLIF(SUM(e_{k} * e_{k}), 0), 0)"


def _ols_ctes() -> None:
    source = "ols_0"
    cte(
        source,
        f"""
SELECT *, "Year" <= {LAST_TRAIN_YEAR} AS fit, CAST("Year" AS DOUBLE) AS x_1,
  {", ".join(f'"{n}" AS x_{i}' for i, n in enumerate(OLS_FEATURES[1:], 2))}
FROM weather_model
""",
        "weather_model",
    )
    n = len(OLS_FEATURES)
    for k in range(n):
        columns = []
        for i in range(k + 1, n + 1):
            x = f"x_{i}" if k == 0 else f"e_{i}"
            if k == 0:
                columns.append(f"{x} - (SELECT AVG({x}) FROM {source} WHERE fit) AS e_{i}")
            elif i > k:
                slope = f"(SELECT {_projection(x, k)} FROM {source} WHERE fit)"
                columns.append(f"{x} - {slope} * e_{k} AS e_{i}")
        kept = [f"e_{i}" for i in range(1, k + 1)] if k else []
        base = ['"State"', '"Year"', '"Yield_bu_acre"', "fit", *kept, *columns]
        cte(f"ols_{k + 1}", f"SELECT {', '.join(base)} FROM {source}", source)
        source = f"ols_{k + 1}"
    terms = " + ".join(
        f"""(SELECT {_projection('"Yield_bu_acre"', i)} FROM {source} WHERE fit) * e_{i}"""
        for i in range(1, n + 1)
    )
    cte(
        "ols",
        f"""
SELECT "State", "Year", "Yield_bu_acre", fit,
  (SELECT AVG("Yield_bu_acre") FROM {source} WHERE fit) + {terms} AS prediction
FROM {source}
""",
        source,
    )


_ols_ctes()
METRICS_SQL = """
COUNT(*) AS n_rows, AVG(e * e) AS mse, SQRT(AVG(e * e)) AS rmse, AVG(ABS(e)) AS mae,
1 - AVG(e * e) / NULLIF(VAR_POP("Yield_bu_acre"), 0) AS r2
"""


def _fitted(df: DataFrame) -> DataFrame:
    """Four digits: a fitted value carries the solver's own rounding."""
    return rounded(df, 4)


def _fit_ols(rows: DataFrame) -> regression.Fitted:
    features = regression.TREND_WEATHER_FEATURES
    return regression.fit(regression.ordinary_least_squares(), _train(rows), features)


@register(
    with_ctes(
        f"""
SELECT "State", "Year", {r("Yield_bu_acre", "prediction", digits=4)}
FROM ols
""",
        "ols",
    )
)
def ols_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(weather_model_rows(spark, sf_dir).dropna(subset=[LABEL]), "rows")
    scored = _fit_ols(rows).predict(rows)
    return _fitted(scored.select("State", "Year", LABEL, "prediction"))


@register(
    with_ctes(
        f"""
SELECT n_rows, {r("mse", "rmse", "mae", "r2", digits=4)}
FROM (SELECT {METRICS_SQL}
      FROM (SELECT *, "Yield_bu_acre" - prediction AS e FROM ols WHERE NOT fit))
""",
        "ols",
    )
)
def ols_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(weather_model_rows(spark, sf_dir).dropna(subset=[LABEL]), "rows")
    validation = splits.temporal_split(rows, LAST_TRAIN_YEAR)[1]
    scored = _fit_ols(rows).predict(validation)
    return _fitted(metrics.regression_metrics(scored, LABEL))


@register(
    with_ctes(
        f"""
SELECT "State", n_rows, {r("mse", "rmse", "mae", "r2")}
FROM (SELECT "State", {METRICS_SQL}
      FROM (SELECT y.*, "Yield_bu_acre" - m AS e FROM county_yields y
            CROSS JOIN (SELECT AVG("Yield_bu_acre") AS m FROM county_yields
                        WHERE "Year" <= {LAST_TRAIN_YEAR})
            WHERE "Year" > {LAST_TRAIN_YEAR})
      GROUP BY 1)
""",
        "county_yields",
    )
)
def metrics_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the training mean as prediction, per state."""
    rows = county_yields(spark, sf_dir)
    train, validation = splits.temporal_split(rows, LAST_TRAIN_YEAR)
    mean = train.agg(F.avg(LABEL)).scalar()
    scored = validation.withColumn("prediction", mean)
    return rounded(metrics.regression_metrics(scored, LABEL, by=["State"]))


@register(
    f"""
SELECT 'quantity' AS feature,
  {rounded_sql("sign(c) * GREATEST(ABS(c) - 0.01e0, 0) / v", 4)} AS coefficient
FROM (SELECT COVAR_POP(l_extendedprice / 1000e0, l_quantity) AS c, VAR_POP(l_quantity) AS v
      FROM lineitem WHERE year(l_shipdate) <= {LAST_TRAIN_YEAR})
"""
)
def lasso_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature, where the penalty shrinks the covariance by exactly alpha."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.year("l_shipdate").alias("Year"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") / 1000).alias(LABEL),
    )
    fitted = regression.fit(regression.lasso(), _train(rows), ["quantity"])
    return _fitted(reports.coefficients(spark, fitted))


# --- lasso over features that never meet -------------------------------------
# A feature is one group's quantity or discount less that group's training mean, and 0 in
# all other groups. Such features are orthogonal, so each weight is a soft threshold of
# its own covariance: the discounts, which tell nothing, get exactly 0.
_GROUPS = [f"{flag}{line}" for flag in "ANR" for line in range(1, 8)]
_GROUP_ALPHA = 0.05


@register(
    f"""
SELECT feature, {rounded_sql("sign(c) * GREATEST(ABS(c) - 0.05e0, 0) / v", 4)} AS coefficient
FROM (
  SELECT 'x_' || g AS feature, SUM((x - mx) * (y - my)) / ANY_VALUE(n) AS c,
    SUM((x - mx) * (x - mx)) / ANY_VALUE(n) AS v
  FROM (SELECT *, AVG(x) OVER (PARTITION BY g) AS mx, AVG(y) OVER () AS my, COUNT(*) OVER () AS n
    FROM (SELECT l_returnflag || CAST(l_linenumber AS VARCHAR) AS g,
        CASE WHEN l_linenumber % 2 = 1 THEN l_quantity ELSE l_discount * 100 END AS x,
        l_extendedprice / 1000e0 AS y
      FROM lineitem WHERE year(l_shipdate) <= {LAST_TRAIN_YEAR}))
  GROUP BY g)
ORDER BY ABS(coefficient) DESC, feature LIMIT 20
"""
)
def lasso_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest of 21 weights; the features are orthogonal and some weights are 0."""
    items = _train(
        table(spark, sf_dir, "lineitem").select(
            F.year("l_shipdate").alias("Year"),
            F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("g"),
            F.when(F.col("l_linenumber") % 2 == 1, F.col("l_quantity"))
            .otherwise(F.col("l_discount") * 100)
            .alias("x"),
            (F.col("l_extendedprice") / 1000).alias(LABEL),
        )
    )
    means = items.groupBy("g").agg(F.avg("x").alias("mean"))
    centred = items.join(means, "g").select(
        LABEL,
        *[
            F.when(F.col("g") == g, F.col("x") - F.col("mean")).otherwise(0.0).alias(f"x_{g}")
            for g in _GROUPS
        ],
    )
    names = [f"x_{g}" for g in _GROUPS]
    fitted = regression.fit(regression.lasso(_GROUP_ALPHA), centred, names)
    return _fitted(reports.coefficients(spark, fitted, k=20))


# --- trees -------------------------------------------------------------------
TREE_FEATURES = ["Year", *MONTH_FEATURES]


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State matrix with the last year's gaps filled from history; others stay missing."""
    dataset = state_month_dataset(panel(spark, sf_dir), state_yields(spark, sf_dir))
    return fill_from_history(materialize(dataset, "matrix"), TARGET_YEAR, MONTH_FEATURES)


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix with what is still missing at its training mean."""
    rows = materialize(_matrix(spark, sf_dir), "matrix")
    return scaling.fill_with_means(_train(rows), rows, MONTH_FEATURES)


_HISTORY = ", ".join(f'AVG("{f}") AS "{f}"' for f in MONTH_FEATURES)
_FROM_HISTORY = ", ".join(
    f'CASE WHEN c."Year" = {TARGET_YEAR} THEN COALESCE(c."{f}", h."{f}") ELSE c."{f}" END AS "{f}"'
    for f in MONTH_FEATURES
)
cte(
    "tree_rows",
    f"""
SELECT c."State", c."Year", c."Yield_bu_acre", c."Year" <= {LAST_TRAIN_YEAR} AS fit, {_FROM_HISTORY}
FROM state_dataset c LEFT JOIN (
  SELECT "State", {_HISTORY} FROM state_dataset WHERE "Year" < {TARGET_YEAR} GROUP BY 1) h
ON h."State" = c."State"
""",
    "state_dataset",
)
cte(
    "tree_cells",
    " UNION ALL ".join(
        f"""SELECT "State", "Year", fit, {i} AS place, '{f}' AS feature, CAST("{f}" AS DOUBLE) AS x,
        "Yield_bu_acre" - (SELECT AVG("Yield_bu_acre") FROM tree_rows WHERE fit) AS y FROM tree_rows"""
        for i, f in enumerate(TREE_FEATURES)
    ),
    "tree_rows",
)
# Every way to cut the training rows in two: behind each value of each feature, with the
# rows that miss the feature on the right or on the left.
cte(
    "tree_cuts",
    """
SELECT *, ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn AS gain FROM (
  SELECT place, feature, x, nx, missing_left, tn, ts,
    n + CASE WHEN missing_left THEN mn ELSE 0 END AS ln,
    s + CASE WHEN missing_left THEN ms ELSE 0 END AS ls
  FROM (
    SELECT place, feature, x, LEAD(x) OVER v AS nx, SUM(n) OVER v AS n, SUM(s) OVER v AS s
    FROM (SELECT place, feature, x, COUNT(*) AS n, SUM(y) AS s FROM tree_cells
          WHERE fit AND x IS NOT NULL GROUP BY 1, 2, 3)
    WINDOW v AS (PARTITION BY place ORDER BY x))
  JOIN (
    SELECT place, COUNT(*) AS tn, SUM(y) AS ts, COUNT(*) - COUNT(x) AS mn,
      COALESCE(SUM(CASE WHEN x IS NULL THEN y END), 0) AS ms
    FROM tree_cells WHERE fit GROUP BY 1) USING (place),
  (VALUES (FALSE), (TRUE)) AS m(missing_left)
  WHERE NOT missing_left OR mn > 0)
WHERE ln < tn
""",
    "tree_cells",
)
cte(
    "boosted_cut",
    """
SELECT * FROM tree_cuts WHERE ln >= 20 AND tn - ln >= 20
ORDER BY gain DESC, place, missing_left, x LIMIT 1
""",
    "tree_cuts",
)


@register(
    with_ctes(
        f"""
SELECT 0 AS tree, node, feature, {r("threshold", "gain", "value", digits=4)} FROM (
  SELECT 0 AS node, feature, COALESCE((x + nx) / 2, CAST('infinity' AS DOUBLE)) AS threshold,
    gain, CAST(NULL AS DOUBLE) AS value FROM boosted_cut
  UNION ALL SELECT 1, NULL, NULL, NULL, ls / ln FROM boosted_cut
  UNION ALL SELECT 2, NULL, NULL, NULL, (ts - ls) / (tn - ln) FROM boosted_cut)
""",
        "boosted_cut",
    )
)
def boosting_first_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of one split over all features: the best cut there is."""
    booster = boosting.LeafwiseBoosting(rounds=1, rate=1.0, leaves=2, feature_share=1.0)
    fitted = regression.fit(booster, _train(_matrix(spark, sf_dir)), TREE_FEATURES)
    return _fitted(reports.tree_nodes(spark, fitted))


cte(
    "filled_cells",
    """
SELECT "State", "Year", fit, place, feature, y,
  COALESCE(x, AVG(x) FILTER (fit) OVER (PARTITION BY place)) AS x
FROM tree_cells
""",
    "tree_cells",
)
cte(
    "stump",
    """
SELECT place, feature, (x + nx) / 2 AS threshold, s / n AS low_side, (ts - s) / (tn - n) AS high_side
FROM (
  SELECT place, feature, x, LEAD(x) OVER v AS nx, SUM(n1) OVER v AS n, SUM(s1) OVER v AS s,
    SUM(n1) OVER (PARTITION BY place) AS tn, SUM(s1) OVER (PARTITION BY place) AS ts
  FROM (SELECT place, feature, x, COUNT(*) AS n1, SUM(y) AS s1 FROM filled_cells
        WHERE fit GROUP BY 1, 2, 3)
  WINDOW v AS (PARTITION BY place ORDER BY x))
WHERE n < tn
ORDER BY s * s / n + (ts - s) * (ts - s) / (tn - n) DESC, place, x LIMIT 1
""",
    "filled_cells",
)


def _stump(spark: SparkSession, rows: DataFrame) -> regression.Fitted:
    """A forest of one tree of one split, on all rows."""
    forest = regression.random_forest(trees=1, max_depth=1, bootstrap=False)
    return regression.fit(forest, _train(rows), TREE_FEATURES)


@register(
    with_ctes(
        f"""
SELECT f.feature, CASE WHEN f.feature = s.feature THEN 1e0 ELSE 0e0 END AS importance
FROM (VALUES {", ".join(f"('{f}')" for f in TREE_FEATURES)}) AS f(feature), stump s
ORDER BY importance DESC, f.feature LIMIT 20
""",
        "stump",
    )
)
def stump_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fitted(reports.importances(spark, _stump(spark, _complete(spark, sf_dir))))


_STUMP_SQL = """(SELECT AVG("Yield_bu_acre") FROM tree_rows WHERE fit)
    + CASE WHEN c.x <= s.threshold THEN s.low_side ELSE s.high_side END"""


@register(
    with_ctes(
        f"""
SELECT t."State", {rounded_sql('t."Yield_bu_acre"', 4)} AS "Actual_Yield",
  {rounded_sql(_STUMP_SQL, 4)} AS "Predicted_Yield"
FROM tree_rows t CROSS JOIN stump s
JOIN filled_cells c ON c.place = s.place AND c."State" = t."State" AND c."Year" = t."Year"
WHERE t."Year" = {TARGET_YEAR}
""",
        "tree_rows",
        "stump",
        "filled_cells",
    )
)
def stump_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual and predicted yields of the last year by the best single split."""
    rows = materialize(_complete(spark, sf_dir), "rows")
    return _fitted(reports.prediction_report(_stump(spark, rows), rows, TARGET_YEAR))


@register(
    with_ctes(
        f"""
SELECT model, n_rows, {r("mse", "rmse", "mae", "r2", digits=4)}
FROM (SELECT {METRICS_SQL}
      FROM (SELECT *, "Yield_bu_acre" - prediction AS e FROM ols WHERE NOT fit))
CROSS JOIN (VALUES ('linear'), ('scaled'), ('standardised')) AS m(model)
""",
        "ols",
    )
)
def compare_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares on features as they are and scaled in two ways: the same metrics."""
    rows = materialize(weather_model_rows(spark, sf_dir).dropna(subset=[LABEL]), "rows")
    train, validation = splits.temporal_split(rows, LAST_TRAIN_YEAR)
    models = {x: regression.ordinary_least_squares() for x in ("linear", "scaled", "standardised")}
    preparations = {"scaled": scaling.minmax_scale, "standardised": scaling.standard_scale}
    features = regression.TREND_WEATHER_FEATURES
    return _fitted(
        reports.compare_models(models, train, validation, features, preparations=preparations)
    )


@register()
def lasso_coefs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_complete(spark, sf_dir), "rows")
    train = _train(rows)
    scaled = scaling.minmax_scale(train, train, MONTH_FEATURES)
    return reports.coefficients(
        spark, regression.fit(regression.lasso(), scaled, MONTH_FEATURES)
    )


@register()
def rf_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _train(_complete(spark, sf_dir))
    return reports.importances(
        spark, regression.fit(regression.random_forest(trees=50), train, TREE_FEATURES)
    )


@register()
def gbt_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """100 rounds of 51 leaves over all features, missing ones as they are."""
    train, validation = splits.temporal_split(_matrix(spark, sf_dir), LAST_TRAIN_YEAR)
    boosted = regression.gradient_boosting()
    return reports.compare_models({"boosted": boosted}, train, validation, TREE_FEATURES)


@register()
def model_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four models over all features, each on the features as it takes them."""
    rows = materialize(_complete(spark, sf_dir), "rows")
    train, validation = splits.temporal_split(rows, LAST_TRAIN_YEAR)
    models = {
        "forest": regression.random_forest(trees=100),
        "linear": regression.ordinary_least_squares(),
        "linear_scaled": regression.ordinary_least_squares(),
        "lasso": regression.lasso(),
    }
    scaled = {"linear_scaled": scaling.minmax_scale, "lasso": scaling.minmax_scale}
    return reports.compare_models(models, train, validation, TREE_FEATURES, preparations=scaled)


@register()
def ranked_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten features most correlated with the yield, and the year, as input of a forest."""
    dataset = state_month_dataset(panel(spark, sf_dir), state_yields(spark, sf_dir))
    dataset = materialize(dataset, "matrix")
    ranked = profiling.target_correlations(dataset, LABEL, TREE_FEATURES)
    leading = leading_names(top_by_abs(ranked, "corr", k=10))
    features = list(dict.fromkeys(["Year", *leading]))
    filled = fill_from_history(dataset, TARGET_YEAR, MONTH_FEATURES)
    train, validation = splits.temporal_split(filled, LAST_TRAIN_YEAR)
    return reports.compare_models(
        {"forest": regression.random_forest(trees=50)},
        train,
        validation,
        features,
        preparations={"forest": scaling.fill_with_means},
    )


@register()
def predict_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_complete(spark, sf_dir), "rows")
    fitted = regression.fit(regression.random_forest(trees=50), _train(rows), TREE_FEATURES)
    return reports.prediction_report(fitted, rows, TARGET_YEAR)


# --- sequences ---------------------------------------------------------------
_VECTOR_SQL = " UNION ALL ".join(
    f"""SELECT "Year", "State", ("Week" - 1) * {len(schemas.SEQUENCE_FEATURES)} + {i} AS place,
    CAST("{f}" AS DOUBLE) AS value FROM season_weeks"""
    for i, f in enumerate(schemas.SEQUENCE_FEATURES)
)


@register(
    with_ctes(
        f"""
SELECT "Year", "State", CAST(place AS INTEGER) AS place, {r("value")} FROM ({_VECTOR_SQL})
""",
        "season_weeks",
    )
)
def sequence_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened sequences, one row per place of the vector."""
    flat = _samples(spark, sf_dir).withColumn("flat", flatten_steps("features"))
    return rounded(flat.select("Year", "State", F.posexplode("flat").alias("place", "value")))


@register(
    with_ctes(
        f"""
SELECT "Year", "State", split, {r("scaled", "restored")} FROM (
  SELECT "Year", "State", split, target AS restored, (target - AVG(target) FILTER (split = 'train') OVER ())
    / COALESCE(NULLIF(STDDEV_POP(target) FILTER (split = 'train') OVER (), 0), 1) AS scaled
  FROM (
    SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('42|' || CAST("Year" AS VARCHAR) || '|' || "State"))
      <= COUNT(*) OVER () - CEIL(0.2e0 * COUNT(*) OVER ()) THEN 'train' ELSE 'validation' END AS split
    FROM (SELECT "Year", "State", arg_max("Yield_bu_acre", "Week") AS target
          FROM season_weeks GROUP BY 1, 2)
    WHERE target IS NOT NULL))
""",
        "season_weeks",
    )
)
def sequence_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets of a seeded split, scaled by its training part and taken back again."""
    samples = materialize(_samples(spark, sf_dir).dropna(subset=["target"]), "samples")
    marked = splits.seeded_split(samples.select("Year", "State", "target"), ["Year", "State"])
    marked = materialize(marked, "marked")
    train = marked.filter("split = 'train'")
    scaled = scaling.standard_scale(train, marked, ["target"])
    both = scaled.select(
        "Year", "State", "split", F.col("target").alias("scaled"), F.col("target").alias("restored")
    )
    return rounded(scaling.inverse_scale(train, both, ["restored"], "target"))


@register()
def sequence_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences, padded to the season, scaled and flattened, as input of a forest."""
    samples = _samples(spark, sf_dir).dropna(subset=["target"])
    width = len(schemas.SEQUENCE_FEATURES)
    samples = materialize(pad_sequences(samples, schemas.SEASON_WEEKS, width), "samples")
    train = samples.filter(F.col("Year") <= LAST_TRAIN_YEAR)
    # After scaling 0 is the training mean, which missing values take.
    steps = F.transform(
        "features",
        lambda step: F.transform(step, lambda value: F.coalesce(value, F.lit(0.0))),
    )
    scaled = scaling.scale_sequences(train, samples, width).withColumn("features", steps)
    vectors = materialize(regression.sequence_vectors(scaled), "vectors")
    forest = regression.random_forest(trees=50)
    ready = forest.copy(
        {forest.featuresCol: regression.VECTOR, forest.labelCol: "target"}
    )
    model = ready.fit(vectors.filter(F.col("Year") <= LAST_TRAIN_YEAR))
    scored = model.transform(vectors.filter(F.col("Year") > LAST_TRAIN_YEAR))
    return scored.select("Year", "State", "target", "prediction")
