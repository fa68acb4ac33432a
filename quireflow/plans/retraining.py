"""Registered queries: the tabular retraining steps."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quireflow.functions import hashing
from quireflow.operators import evaluate, registry, splits, tabular
from quireflow.plans import sqltext as q
from quireflow.plans.tables import load, versions
from quireflow.session import stored

# The names under which an earlier run would have logged its parameters. All
# are text, as is the column list.
PARAMS = {
    "columns": "['p_size', 'brand_no', 'series', 'p_type']",
    "preprocessor__numerical__imputer__strategy": "mean",
    "preprocessor__onehot__handle_unknown": "ignore",
    "preprocessor__remainder": "drop",
    "regressor__bootstrap": "True",
    "regressor__max_depth": "8",
    "regressor__max_features": "0.8",
    "regressor__min_samples_leaf": "0.001",
    "regressor__n_estimators": "20",
    "regressor__random_state": "20260",
}
NUMERIC, CATEGORICAL, TARGET = ["p_size", "brand_no", "series"], ["p_type"], "p_retailprice"


def logged_params(spark, d):
    """Parameter rows of every run that is behind a Production version."""
    runs = versions(spark, d).where("stage = 'Production'").select("run_id").distinct()
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in PARAMS.items()])
    return runs.select("run_id", F.explode(entries).alias("e")).select("run_id", "e.*")


def _stored_params(spark, d):
    """Parameters of the newest Production version of one model, read from the tables."""
    found = versions(spark, d)
    name = found.where("stage = 'Production'").agg(F.min("name")).first()[0]
    newest = registry.require_latest(found, name, "Production")
    return registry.params_of(logged_params(spark, d), newest["run_id"])


def _trains(key):
    return hashing.stable_bucket(1000, key) < 600


def _gaps(spark, d):
    """Customers whose negative balances count as missing."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return load(spark, d, "customer").select("c_custkey", balance.alias("c_acctbal"))


def numeric_coerce(spark, d):
    cols = ["p_brand", "p_size", "digits"]
    parts = load(spark, d, "part").withColumn("digits", F.substring("p_brand", 7, 2))
    return tabular.coerce_numeric(parts.select("p_partkey", *cols), cols)


def _impute(strategy):
    def run(spark, d):
        gaps = _gaps(spark, d)
        filled = tabular.impute(gaps.where(_trains("c_custkey")), ["c_acctbal"], strategy).transform(gaps)
        return filled.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))
    return run


def impute_median(spark, d):
    gaps = _gaps(spark, d)
    filled = tabular.impute_exact_median(gaps.where(_trains("c_custkey")), gaps, ["c_acctbal"])
    return filled.select("c_custkey", F.round("c_acctbal", 6).alias("c_acctbal"))


def standardise(spark, d):
    parts = load(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    cols = ["p_size", "p_retailprice"]
    scaled = tabular.standardise(parts, tabular.scale_params(parts.where(_trains("p_partkey")), cols))
    return scaled.select("p_partkey", *[F.round(c, 6).alias(c) for c in cols])


def one_hot(spark, d):
    """Fitted without customers of one segment's training rows, so that unseen values occur:
    they are all zeros."""
    people = load(spark, d, "customer").select("c_custkey", "c_mktsegment")
    training = people.where(_trains("c_custkey") & (F.col("c_mktsegment") != "MACHINERY"))
    coded = Pipeline(stages=tabular.one_hot_stages(["c_mktsegment"])).fit(training).transform(people)
    bits = vector_to_array("c_mktsegment_hot").cast("array<int>").cast("array<string>")
    return coded.select("c_custkey", F.array_join(bits, " ").alias("hot"))


def _features(spark, d):
    parts = load(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("double")).alias("p_size"),
        F.substring("p_brand", 7, 2).alias("brand_no"), (F.col("p_partkey") % 1000).alias("series"),
        "p_type", "p_retailprice",
    )
    return splits.with_split(parts, "p_partkey", cuts=splits.CUTS_60_20_20)


def select_from_params(spark, d):
    """The columns that a stored parameter names."""
    stored_list = _stored_params(spark, d)["columns"]
    return tabular.select_named(_features(spark, d), stored_list, ["p_partkey"])


def assembled_features(spark, d):
    """The forest's input vector, entry by entry: imputed numbers, then one-hot types, all
    fitted on the training split."""
    data = tabular.coerce_numeric(_features(spark, d), NUMERIC)
    stages = tabular.feature_stages(_stored_params(spark, d), NUMERIC, CATEGORICAL)
    ready = Pipeline(stages=stages).fit(data.where("split = 'train'")).transform(data)
    cells = F.posexplode(vector_to_array("assembled")).alias("pos", "v")
    return ready.select("p_partkey", "split", cells).select("p_partkey", "split", "pos", F.round("v", 6).alias("value"))


def regression_metrics(spark, d):
    """Metrics of a fixed guess, per split."""
    guessed = _features(spark, d).withColumn("guess", 900.0 + F.col("p_partkey") / 10)
    found = evaluate.regression_metrics(guessed, TARGET, "guess", "split")
    return found.select("split", "rows", "incomplete", *[F.round(c, 4).alias(c) for c in ("mse", "rmse", "mae", "r2")])


def regression_metrics_gaps(spark, d):
    """The same with missing guesses and targets, a split with a constant target and one
    without any pair."""
    key = F.col("p_partkey")
    guessed = _features(spark, d).select(
        F.when(key % 11 == 0, "none").when(F.col("split") == "test", "flat").otherwise(F.col("split")).alias("split"),
        F.when(key % 5 != 0, F.when(F.col("split") == "test", 900.0).otherwise(F.col(TARGET))).alias("target"),
        F.when((key % 7 != 0) & (key % 11 != 0), 900.0 + key / 10).alias("guess"))
    found = evaluate.regression_metrics(guessed, "target", "guess", "split")
    return found.select("split", "rows", "incomplete", *[F.round(c, 4).alias(c) for c in ("mse", "rmse", "mae", "r2")])


def rf_retrain(spark, d):
    """Retrain as the newest Production version's parameters say, on the training split:
    rows, missing predictions, and whether the forest beats the training mean."""
    params = _stored_params(spark, d)
    data = stored(_features(spark, d), "tabular")
    wanted = tabular.select_named(data, params["columns"], ["p_partkey", "split", TARGET])
    train = wanted.where("split = 'train'")
    model = tabular.retrain(train, params, NUMERIC, CATEGORICAL, TARGET)
    mean = train.agg(F.avg(TARGET)).first()[0]
    scored = model.transform(tabular.coerce_numeric(wanted, NUMERIC))
    off = F.pow(F.col(TARGET) - F.col("prediction"), 2)
    return scored.groupBy("split").agg(
        F.count("*").alias("rows"), F.count(F.when(F.col("prediction").isNull(), 1)).alias("missing"),
        (F.avg(off) < F.avg(F.pow(F.col(TARGET) - mean, 2))).alias("beats_mean"))


#: One tree without sampling: what it must be follows from the data, so SQL can grow it again.
TREE = {**PARAMS, "regressor__bootstrap": "False", "regressor__max_depth": "2", "regressor__max_features": "1.0",
        "regressor__min_samples_leaf": "0.0", "regressor__n_estimators": "1"}
TREE_NUMERIC = ["size_class", "brand_no", "decade"]


def rf_tree_walk(spark, d):
    """A tree retrained on the training split, read back as node rows; every part is walked to
    its leaf. Prices count in tenths."""
    parts = _features(spark, d).select(
        "p_partkey", "split", F.floor(F.col("p_size") / 4).alias("size_class"), "brand_no",
        F.floor(F.col("series") / 40).alias("decade"), "p_type", F.round(F.col(TARGET) * 10).alias("tenths"))
    data = stored(tabular.coerce_numeric(parts, TREE_NUMERIC), "tree_rows")
    model = tabular.retrain(data.where("split = 'train'"), TREE, TREE_NUMERIC, CATEGORICAL, "tenths")
    nodes = tabular.forest_nodes(spark, model.stages[-1])
    ready = model.transform(data).drop("prediction")
    walked = tabular.walk_forest(nodes, ready, "p_partkey", depth=int(TREE["regressor__max_depth"]))
    leaves = nodes.where("feature IS NULL").select("node", F.col("rows").alias("leaf_rows"))
    return (walked.withColumn("node", F.get("leaves", F.lit(0))).join(leaves, "node")
            .select("p_partkey", "leaf_rows", F.round("prediction", 6).alias("prediction")))


QUERIES = {
    "numeric_coerce": numeric_coerce,
    "impute_mean": _impute("mean"),
    "impute_mode": _impute("most_frequent"),
    "impute_median": impute_median,
    "standardise": standardise,
    "one_hot": one_hot,
    "regression_metrics": regression_metrics,
    "regression_metrics_gaps": regression_metrics_gaps,
    "select_from_params": select_from_params,
    "assembled_features": assembled_features,
    "rf_retrain": rf_retrain,
    "rf_tree_walk": rf_tree_walk,
}


def _tree_sql(features: str) -> str:
    """Grows the tree of ``rf_tree_walk``: per node the cut with the greatest fall of variance
    among the midpoints of all training values, ties to the first feature and least cut."""
    def grown(rows: str, out: str) -> str:
        return f"""{out}_c AS (SELECT c.f, c.cut, v.node, count(*) FILTER (x <= cut) AS n, sum(y) FILTER (x <= cut) AS s,
            count(*) AS m, sum(y) AS t FROM cuts c JOIN (SELECT * FROM {rows} WHERE split = 'train') v ON v.f = c.f GROUP BY ALL),
          {out}_b AS (SELECT node, arg_min({{'f': f, 'cut': cut}}, {{'g': -(s * s / n::DOUBLE + (t - s) * (t - s) / (m - n)::DOUBLE),
            'f': f, 'cut': cut}}) AS b FROM {out}_c WHERE n > 0 AND n < m GROUP BY node),
          {out}_w AS (SELECT r.k, 2 * r.node + (r.x > b.b.cut)::INT AS node FROM {rows} r JOIN {out}_b b
            ON b.node = r.node AND b.b.f = r.f),
          {out} AS (SELECT r.* REPLACE (w.node AS node) FROM {rows} r JOIN {out}_w w USING (k))"""
    return f"""WITH raw AS (SELECT p_partkey AS k, split, floor(p_size / 4)::DOUBLE AS a, try_cast(brand_no AS DOUBLE) AS b,
        floor(series / 40)::DOUBLE AS c, p_type, round(p_retailprice * 10)::BIGINT AS y FROM {features}),
      fill AS (SELECT avg(a) AS fa, avg(b) AS fb, avg(c) AS fc FROM raw WHERE split = 'train'),
      kinds AS (SELECT p_type AS kind, row_number() OVER (ORDER BY p_type) + 2 AS f
        FROM (SELECT DISTINCT p_type FROM raw WHERE split = 'train')),
      v0 AS (SELECT k, split, y, 0 AS f, coalesce(a, fa) AS x, 1 AS node FROM raw, fill
        UNION ALL SELECT k, split, y, 1, coalesce(b, fb), 1 FROM raw, fill
        UNION ALL SELECT k, split, y, 2, coalesce(c, fc), 1 FROM raw, fill
        UNION ALL SELECT k, split, y, f, (kind = p_type)::INT::DOUBLE, 1 FROM raw, kinds),
      cuts AS (SELECT f, (x + y) / 2 AS cut FROM (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS y
        FROM (SELECT DISTINCT f, x FROM v0 WHERE split = 'train')) WHERE y IS NOT NULL),
      {grown('v0', 'v1')}, {grown('v1', 'v2')},
      leaves AS (SELECT node, count(*) AS leaf_rows, avg(y) AS prediction FROM v2 WHERE f = 0 AND split = 'train' GROUP BY node)
      SELECT k AS p_partkey, leaf_rows::BIGINT AS leaf_rows, round(prediction, 6) AS prediction
      FROM (SELECT k, node FROM v2 WHERE f = 0) JOIN leaves USING (node)"""


def oracles() -> dict[str, str]:
    split = q.split_name(q.bucket(1000, "p_partkey"), splits.CUTS_60_20_20)
    trains = "{} < 600".format(q.bucket(1000, "c_custkey"))
    part_trains = "{} < 600".format(q.bucket(1000, "p_partkey"))
    features = f"""(SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS p_size, substr(p_brand, 7, 2) AS brand_no,
      p_partkey % 1000 AS series, p_type, p_retailprice, {split} AS split FROM part)"""
    metrics = """count(e) AS "rows", count(*) FILTER (e IS NULL) AS incomplete, round(avg(e * e), 4) AS mse,
      round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
      round(1 - sum(e * e) / nullif(count(e) * var_pop(CASE WHEN e IS NOT NULL THEN target END), 0), 4) AS r2"""
    filled = "SELECT c_custkey, round(CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE ({}) END, 6) AS c_acctbal FROM customer"
    have = f"FROM customer WHERE c_acctbal >= 0 AND {trains}"
    z = ("round(({0} - avg({0}) FILTER (" + part_trains + ") OVER ()) / stddev_pop({0}) FILTER ("
         + part_trains + ") OVER (), 6) AS {0}")
    return {
        "numeric_coerce": """SELECT p_partkey, try_cast(p_brand AS DOUBLE) AS p_brand, p_size::DOUBLE AS p_size,
          try_cast(substr(p_brand, 7, 2) AS DOUBLE) AS digits FROM part""",
        "impute_mean": filled.format(f"SELECT avg(c_acctbal) {have}"),
        "impute_mode": filled.format(
            f"SELECT c_acctbal {have} GROUP BY c_acctbal ORDER BY count(*) DESC, c_acctbal LIMIT 1"),
        "impute_median": filled.format(f"SELECT median(c_acctbal) {have}"),
        "standardise": f"SELECT p_partkey, {z.format('p_size')}, {z.format('p_retailprice')} FROM part",
        "one_hot": f"""SELECT c_custkey, array_to_string(list_transform(
            (SELECT list(s ORDER BY s) FROM (SELECT DISTINCT c_mktsegment AS s FROM customer WHERE {trains} AND c_mktsegment <> 'MACHINERY')),
            lambda s: (s = c_mktsegment)::INT), ' ') AS hot FROM customer""",
        "regression_metrics": f"""SELECT split, {metrics} FROM (SELECT {split} AS split, p_retailprice AS target,
            p_retailprice - (900.0 + p_partkey / 10) AS e FROM part) GROUP BY split""",
        "regression_metrics_gaps": f"""SELECT split, {metrics} FROM (SELECT split, target, target - guess AS e FROM
            (SELECT CASE WHEN p_partkey % 11 = 0 THEN 'none' WHEN {split} = 'test' THEN 'flat' ELSE {split} END AS split,
              CASE WHEN p_partkey % 5 <> 0 THEN CASE WHEN {split} = 'test' THEN 900.0::DOUBLE ELSE p_retailprice END END AS target,
              CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 11 <> 0 THEN 900.0 + p_partkey / 10 END AS guess FROM part))
            GROUP BY split""",
        "select_from_params": f"SELECT p_partkey, p_size, brand_no, series, p_type FROM {features}",
        "assembled_features": f"""WITH f AS (SELECT * REPLACE (try_cast(brand_no AS DOUBLE) AS brand_no) FROM {features}),
          fill AS (SELECT avg(p_size) AS s, avg(brand_no) AS b, avg(series) AS r FROM f WHERE split = 'train'),
          kinds AS (SELECT p_type AS kind, (row_number() OVER (ORDER BY p_type) + 2)::INT AS pos
            FROM (SELECT DISTINCT p_type FROM f WHERE split = 'train'))
          SELECT p_partkey, split, 0::INT AS pos, round(coalesce(p_size, s)::DOUBLE, 6) AS value FROM f, fill
          UNION ALL SELECT p_partkey, split, 1, round(coalesce(brand_no, b), 6) FROM f, fill
          UNION ALL SELECT p_partkey, split, 2, round(coalesce(series, r)::DOUBLE, 6) FROM f, fill
          UNION ALL SELECT p_partkey, split, pos, (kind = p_type)::INT::DOUBLE FROM f CROSS JOIN kinds""",
        "rf_retrain": f"""SELECT split, count(*) AS "rows", 0::BIGINT AS missing, true AS beats_mean
          FROM {features} GROUP BY split""",
        "rf_tree_walk": _tree_sql(features),
    }
