"""Model jobs over orders and their customers."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from adflow.operators import ml
from adflow.operators.features import split
from adflow.operators.filters import valid_funnel
from adflow.operators.sets import combine
from adflow.plans.registry import query
from adflow.plans.views import read
from adflow.session import temp_database, work_dir
from adflow.sources.sinks import save_features

CATEGORIES = ["c_mktsegment", "o_orderpriority", "dow"]
NUMBERS = ["o_totalprice", "c_acctbal", "month"]


def _frame(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return rows.select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_mktsegment", "o_orderpriority",
        F.dayofweek("o_orderdate").cast("string").alias("dow"), F.month("o_orderdate").alias("month"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 0.0D WHEN 'O' THEN 1.0D ELSE 2.0D END").alias("cv"),
    )


def _prepared(spark, sf_dir):
    """Prepared features, kept as a table so that training does not redo the joins."""
    ready, fitted = ml.prepare(_frame(spark, sf_dir), CATEGORIES, NUMBERS, "cv")
    table = f"{temp_database(spark, 'features')}.orders"
    save_features(ready.select("o_orderkey", ml.FEATURES, ml.LABEL), table)
    return spark.table(table), fitted, ready


def _parts(spark, sf_dir):
    table, _, _ = _prepared(spark, sf_dir)
    return split(table, ["o_orderkey"], [0.7, 0.3], seed=42)


STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 0.0::DOUBLE WHEN 'O' THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END"


def _rank_sql(c):
    return f"SELECT {c} AS v, row_number() OVER (ORDER BY COUNT(*) DESC, {c}) - 1 AS i FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY {c}"


@query(
    "m6_encode",
    f"""SELECT o_orderkey, CAST(s.i AS DOUBLE) AS c_mktsegment_index, CAST(p.i AS DOUBLE) AS o_orderpriority_index
FROM orders JOIN customer ON o_custkey = c_custkey JOIN ({_rank_sql('c_mktsegment')}) s ON s.v = c_mktsegment JOIN ({_rank_sql('o_orderpriority')}) p ON p.v = o_orderpriority""",
)
def encode(spark, sf_dir):
    rows = _frame(spark, sf_dir)
    cols = CATEGORIES[:2]
    return ml.encoder(cols).fit(rows).transform(rows).select("o_orderkey", *ml.index_names(cols))


@query("m8_assemble", "SELECT s_suppkey, CAST(s_nationkey AS DOUBLE) AS f0, s_acctbal AS f1 FROM supplier")
def assemble(spark, sf_dir):
    rows = ml.assemble(read(spark, sf_dir, "supplier"), ["s_nationkey", "s_acctbal"])
    return rows.select("s_suppkey", vector_to_array(ml.FEATURES).alias("f")).select(
        "s_suppkey", F.get("f", F.lit(0)).alias("f0"), F.get("f", F.lit(1)).alias("f1")
    )


# Price, balance and month as they are, then a one-hot slot per category column: the sum of these
# slots is the number of columns, in every row.
SLOTS_SQL = "o_totalprice AS slot0, c_acctbal AS slot1, CAST(month(o_orderdate) AS DOUBLE) AS slot2, 3.0::DOUBLE AS hot"


def _slots(df):
    slots = vector_to_array(ml.FEATURES)
    return df.withColumn("f", slots).select(
        "*", *[F.get("f", F.lit(i)).alias(f"slot{i}") for i in range(3)],
        F.aggregate(F.slice("f", 4, F.size("f")), F.lit(0.0), lambda a, x: a + x).alias("hot"),
    )


@query(
    "k11_feature_table",
    f"SELECT o_orderkey, {STATUS_SQL} AS label, {SLOTS_SQL} FROM orders JOIN customer ON o_custkey = c_custkey",
)
def feature_table(spark, sf_dir):
    table, _, _ = _prepared(spark, sf_dir)
    return _slots(table).select("o_orderkey", "label", "slot0", "slot1", "slot2", "hot")


@query(
    "m9_index_vector",
    'SELECT CAST(dense_rank() OVER (ORDER BY l_linenumber) - 1 AS DOUBLE) AS line_index, COUNT(*) AS "rows" FROM lineitem GROUP BY l_linenumber',
)
def index_vector(spark, sf_dir):
    rows = ml.assemble(read(spark, sf_dir, "lineitem"), ["l_linenumber", "l_quantity", "l_discount"])
    indexed = ml.index_vector(rows, 16).transform(rows)
    return indexed.select("l_orderkey", F.get(vector_to_array("indexed"), F.lit(0)).alias("line_index")).groupBy(
        "line_index"
    ).agg(F.count("*").alias("rows"))


@query("m10_pca")
def pca(spark, sf_dir):
    table, _, _ = _prepared(spark, sf_dir)
    return ml.explained_variance(table, 10)


@query(
    "m10_pca_two_columns",
    """WITH c AS (SELECT VAR_SAMP(s_nationkey) AS a, VAR_SAMP(s_acctbal / 100) AS d, COVAR_SAMP(s_nationkey, s_acctbal / 100) AS b FROM supplier),
e AS (SELECT (a + d) / 2 + sqrt(((a - d) / 2) ** 2 + b * b) AS big, a + d AS total FROM c)
SELECT 1 AS component, round(big / total, 6) AS variance, round(big / total, 6) AS cumulative FROM e
UNION ALL SELECT 2, round(1 - big / total, 6), 1.0 FROM e""",
)
def pca_two_columns(spark, sf_dir):
    """Two columns, whose eigenvalues have a closed form."""
    rows = read(spark, sf_dir, "supplier").selectExpr("s_nationkey", "s_acctbal / 100 AS balance")
    shares = ml.explained_variance(ml.assemble(rows, ["s_nationkey", "balance"]), 2)
    return shares.select("component", F.round("variance", 6).alias("variance"), F.round("cumulative", 6).alias("cumulative"))


def _decided(spark, sf_dir):
    """Orders whose status code, one of the features, decides the label; the month does not."""
    rows = _frame(spark, sf_dir).withColumn("status", F.col("cv")).withColumn("month", F.col("month").cast("double"))
    ready = ml.assemble(rows, ["status", "month"]).withColumn(ml.LABEL, F.col("cv"))
    table = f"{temp_database(spark, 'decided')}.orders"
    save_features(ready.select("o_orderkey", ml.FEATURES, ml.LABEL), table)
    return spark.table(table), ready


DECIDED_SQL = f"SELECT {STATUS_SQL} AS label, {STATUS_SQL} AS prediction, COUNT(*) AS \"rows\" FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"
# Boosting fits one tree after the other: its labelled rows are bounded, its grid and folds are not.
BOOSTED_ROWS = 1000


@query("m12_random_forest", DECIDED_SQL)
def random_forest(spark, sf_dir):
    table, _ = _decided(spark, sf_dir)
    return ml.confusion(ml.score(ml.fit_rf(table, 20), table))


@query("m12_random_forest_split")
def random_forest_split(spark, sf_dir):
    """Fitted on seven tenths of the rows, scored on the others, with all features."""
    train, test = _parts(spark, sf_dir)
    return ml.confusion(ml.score(ml.fit_rf(train, 20), test))


@query("m13_boosted_classifier", DECIDED_SQL)
def boosted_classifier(spark, sf_dir):
    """Depths 2 and 5, 10 and 100 rounds, three folds."""
    table, _ = _decided(spark, sf_dir)
    search = ml.fit_gbt_cls(ml.labelled_rows(table, "o_orderkey", BOOSTED_ROWS))
    return ml.confusion(ml.score(search.bestModel, table))


@query("m14_boosted_regressor", "SELECT i::INT AS point, 0.0::DOUBLE AS score FROM range(4) AS t(i) WHERE (SELECT COUNT(*) FROM orders) > 0")
def boosted_regressor(spark, sf_dir):
    """Depths 2 and 5, 10 and 100 rounds, three folds: the error of each, rounded."""
    table, ready = _decided(spark, sf_dir)
    search = ml.fit_gbt_reg(ml.labelled_rows(table, "o_orderkey", BOOSTED_ROWS))
    return ml.search_scores(search, ready).withColumn("score", F.round("score", 6))


@query("m15_importances", "SELECT name, importance FROM (VALUES ('status', 1.0::DOUBLE), ('month', 0.0::DOUBLE)) AS t(name, importance) WHERE (SELECT COUNT(*) FROM orders) > 0")
def importances(spark, sf_dir):
    table, ready = _decided(spark, sf_dir)
    found = ml.importances(ml.fit_rf(table, 20), ready)
    return found.withColumn("importance", F.round("importance", 6))


# --- real features, trees of one split -------------------------------------
#
# With a bin per value a tree of depth one is the best of all splits of all features, which SQL
# can search: the features in steps, so that a bin per value is enough at any size.

STEPS = {
    "price": "CAST(floor(o_totalprice / 10000) AS DOUBLE)",
    "balance": "CAST(floor(c_acctbal / 500) AS DOUBLE)",
    "month": "CAST(month(o_orderdate) AS DOUBLE)",
    "priority": "CAST(substring(o_orderpriority, 1, 1) AS DOUBLE)",
    "segment": "CAST(length(c_mktsegment) AS DOUBLE)",
}
BINS = 512
# A label that no split tells exactly: it depends on the numbers as they are, not in steps.
LABEL_OF = "CASE WHEN o_totalprice > 150000 + 10 * c_acctbal THEN {0} WHEN o_totalprice > 62500 THEN {1} ELSE {2} END"
LABEL_SQL = LABEL_OF.format(*(f"{k}.0::DOUBLE" for k in range(3)))


def _steps(spark, sf_dir, label=LABEL_OF.format("0.0D", "1.0D", "2.0D")):
    """Orders and their customers as features in steps, as a table."""
    orders, customers = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey).selectExpr(
        "o_orderkey", *[f"{e} AS {c}" for c, e in STEPS.items()], f"{label} AS label")
    ready = ml.assemble(rows, list(STEPS))
    table = f"{temp_database(spark, 'steps')}.orders"
    save_features(ready.select("o_orderkey", ml.FEATURES, ml.LABEL), table)
    return spark.table(table), ready


def _splits_sql(targets):
    """CTEs: rows, and per target the split with the least squared error and its sides' means.
    For shares of classes the sum over the targets is the impurity."""
    columns = ", ".join(f"{e} AS {c}" for c, e in STEPS.items())
    kinds = ", ".join(f"{e} AS {t}" for t, e in targets.items())
    sums = ", ".join(f"SUM({t}) AS s_{t}, SUM({t} * {t}) AS q_{t}" for t in targets)
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {k} AS place, {c} AS v, COUNT(*) AS n, {sums} FROM d GROUP BY {c}"
        for k, c in enumerate(STEPS))
    window = "OVER (PARTITION BY feature ORDER BY v)"
    below = ", ".join(f"SUM(s_{t}) {window} AS l_{t}, SUM(s_{t}) OVER (PARTITION BY feature) AS a_{t}" for t in targets)
    return f"""WITH d AS (SELECT o_orderkey, {columns}, {LABEL_SQL} AS label, {kinds}
  FROM orders JOIN customer ON o_custkey = c_custkey),
v AS ({long}),
c AS (SELECT feature, place, v, SUM(n) {window} AS ln, SUM(n) OVER (PARTITION BY feature) AS an, {below},
  LEAD(v) {window} AS after FROM v)"""


def _gain(targets):
    """What a split explains; the larger, the less error is left."""
    return " + ".join(f"l_{t} * l_{t} / ln + (a_{t} - l_{t}) * (a_{t} - l_{t}) / (an - ln)" for t in targets)


def _best(target_list, name):
    gain = _gain(target_list)
    means = ", ".join(f"l_{t} / ln AS lm_{t}, (a_{t} - l_{t}) / (an - ln) AS rm_{t}" for t in target_list)
    return (f"{name} AS (SELECT feature, (v + after) / 2 AS cut, ln, an, {means} FROM c WHERE after IS NOT NULL "
            f"ORDER BY round({gain}, 6) DESC, place, v LIMIT 1)")


def _side(name):
    """Whether a row of d is below the cut of a best split."""
    whens = " ".join(f"WHEN '{c}' THEN d.{c}" for c in STEPS)
    return f"(CASE {name}.feature {whens} END <= {name}.cut)"


CLASSES = {f"k{k}": f"CASE WHEN {LABEL_SQL} = {k} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for k in range(3)}
SIGNS = {f"k{k}": f"CASE WHEN {LABEL_SQL} = {k} THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END" for k in range(3)}


def _argmax(values):
    """The first class with the greatest value."""
    top = f"GREATEST({', '.join(values)})"
    return f"CASE {top} WHEN {values[0]} THEN 0.0::DOUBLE WHEN {values[1]} THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END"


FOREST_SQL = f"""{_splits_sql(CLASSES)}, {_best(list(CLASSES), "b")},
p AS (SELECT d.*, b.feature, CASE WHEN {_side("b")} THEN {_argmax([f"lm_{t}" for t in CLASSES])} ELSE {_argmax([f"rm_{t}" for t in CLASSES])} END AS prediction
  FROM d, b)"""
STUMP = {"trees": 1, "maxDepth": 1, "maxBins": BINS, "bootstrap": False, "featureSubsetStrategy": "all"}


@query("m12_one_split_forest", f"{FOREST_SQL} SELECT label, prediction, COUNT(*) AS \"rows\" FROM p GROUP BY ALL")
def one_split_forest(spark, sf_dir):
    """A forest of one tree and one split, on the real features."""
    table, _ = _steps(spark, sf_dir)
    return ml.confusion(ml.score(ml.fit_rf(table, **STUMP), table))


@query("m18_one_split_score", f"{FOREST_SQL} SELECT o_orderkey, prediction FROM p")
def one_split_score(spark, sf_dir):
    table, _ = _steps(spark, sf_dir)
    return ml.score(ml.fit_rf(table, **STUMP), table).select("o_orderkey", "prediction")


@query(
    "m15_one_split_importances",
    f"""{FOREST_SQL} SELECT f AS name, CASE WHEN f = feature THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS importance
FROM (SELECT unnest([{", ".join(f"'{c}'" for c in STEPS)}]) AS f), b""",
)
def one_split_importances(spark, sf_dir):
    table, ready = _steps(spark, sf_dir)
    return ml.importances(ml.fit_rf(table, **STUMP), ready)


@query(
    "m13_one_split_classifier",
    f"""{_splits_sql(SIGNS)}, {", ".join(_best([t], f"b{t}") for t in SIGNS)}
SELECT label, {_argmax([f"CASE WHEN {_side(f'b{t}')} THEN b{t}.lm_{t} ELSE b{t}.rm_{t} END" for t in SIGNS])} AS prediction, COUNT(*) AS \"rows\"
FROM d, {", ".join(f"b{t}" for t in SIGNS)} GROUP BY ALL""",
)
def one_split_classifier(spark, sf_dir):
    """Boosting of one round: per class the split that tells it from the others best."""
    table, _ = _steps(spark, sf_dir)
    search = ml.fit_gbt_cls(table, depths=(1,), rounds=(1,), folds=2, bins=BINS)
    return ml.confusion(ml.score(search.bestModel, table))


PRICE_LABEL = {"y": "CAST(o_totalprice AS DOUBLE) / 1000"}


@query(
    "m14_one_split_regressor",
    f"""{_splits_sql(PRICE_LABEL)}, {_best(["y"], "b")}
SELECT b.feature AS name, round(sqrt(AVG(power(y - CASE WHEN {_side("b")} THEN lm_y ELSE rm_y END, 2))), 4) AS rmse FROM d, b GROUP BY b.feature""",
)
def one_split_regressor(spark, sf_dir):
    """Boosting of one round: the price from the features in steps, the price's own step among them."""
    table, ready = _steps(spark, sf_dir, "CAST(o_totalprice AS DOUBLE) / 1000")
    best = ml.fit_gbt_reg(table, depths=(1,), rounds=(1,), folds=2, bins=BINS).bestModel
    error = ml.score(best, table).agg(
        F.round(F.sqrt(F.avg(F.pow(F.col(ml.LABEL) - F.col("prediction"), 2))), 4).alias("rmse"))
    chosen = ml.importances(best, ready).where("importance > 0.5").first()["name"]
    return error.select(F.lit(chosen).alias("name"), "rmse")


def _moments_sql():
    columns = list(STEPS)
    cells = [f"COVAR_SAMP({a}, {b})" for a in columns for b in columns]
    trace = " + ".join(f"VAR_SAMP({a})" for a in columns)
    squares = " + ".join(f"power({c}, 2)" for c in cells)
    rows = ", ".join(f"{e} AS {c}" for c, e in STEPS.items())
    return f"""SELECT 1.0::DOUBLE AS shares, round(({squares}) / power({trace}, 2), 6) AS squares
FROM (SELECT {rows} FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query("m10_pca_moments", _moments_sql())
def pca_moments(spark, sf_dir):
    """All components: their shares add up to the trace, their squares to the Frobenius norm."""
    table, _ = _steps(spark, sf_dir)
    shares = ml.explained_variance(table, len(STEPS))
    return shares.agg(F.round(F.sum("variance"), 6).alias("shares"),
                      F.round(F.sum(F.col("variance") * F.col("variance")), 6).alias("squares"))


# A prediction by rule: the priority's number, over the three classes.
GUESS = "CAST(CAST(substring(o_orderpriority, 1, 1) AS INT) % 3 AS DOUBLE)"


@query(
    "m16_evaluate",
    f"""WITH s AS (SELECT {STATUS_SQL} AS label, {GUESS} AS prediction FROM orders),
k AS (SELECT DISTINCT label AS c FROM s),
m AS (SELECT c, COUNT(*) FILTER (WHERE label = c) AS n, COUNT(*) FILTER (WHERE prediction = c) AS p, COUNT(*) FILTER (WHERE label = c AND prediction = c) AS tp FROM k, s GROUP BY c),
r AS (SELECT n, CASE WHEN p > 0 THEN tp / p ELSE 0 END AS pr, tp / n AS re FROM m)
SELECT 'accuracy' AS metric, round(SUM(tp) / SUM(n), 6) AS value FROM m
UNION ALL SELECT 'f1', round(SUM(n * CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END) / SUM(n), 6) FROM r
UNION ALL SELECT 'weightedPrecision', round(SUM(n * pr) / SUM(n), 6) FROM r
UNION ALL SELECT 'weightedRecall', round(SUM(n * re) / SUM(n), 6) FROM r""",
)
def evaluate(spark, sf_dir):
    scored = read(spark, sf_dir, "orders").select(
        F.expr("CASE o_orderstatus WHEN 'F' THEN 0.0D WHEN 'O' THEN 1.0D ELSE 2.0D END").alias(ml.LABEL),
        F.expr(GUESS).alias("prediction"),
    )
    return ml.evaluate(scored).withColumn("value", F.round("value", 6))


@query("m18_score", f"SELECT o_orderkey, {STATUS_SQL} AS prediction FROM orders JOIN customer ON o_custkey = c_custkey")
def score(spark, sf_dir):
    table, _ = _decided(spark, sf_dir)
    return ml.score(ml.fit_rf(table, 20), table).select("o_orderkey", "prediction")


@query(
    "m19_reloaded_pipeline",
    f"SELECT o_orderkey, {SLOTS_SQL} FROM orders JOIN customer ON o_custkey = c_custkey",
)
def reloaded_pipeline(spark, sf_dir):
    rows = ml.as_doubles(_frame(spark, sf_dir), NUMBERS)
    path = work_dir(spark, "model")
    ml.save_model(ml.feature_pipeline(rows, CATEGORIES, NUMBERS).fit(rows), path)
    scored = ml.load_model(path).transform(rows)
    return _slots(scored).select("o_orderkey", "slot0", "slot1", "slot2", "hot")


# --- synthetic rows --------------------------------------------------------

SEED = 11


def _draw_sql(name):
    return f"CAST(concat('0x', substr(md5(concat('{SEED}|{name}|', CAST(id AS STRING))), 1, 15)) AS BIGINT)"


SEGMENT_SQL = """SELECT v, CAST(SUM(n) OVER (ORDER BY substr(md5(v), 1, 2), v) AS BIGINT) AS high, CAST(SUM(n) OVER (ORDER BY substr(md5(v), 1, 2), v) - n AS BIGINT) AS low
FROM (SELECT c_mktsegment AS v, COUNT(*) AS n FROM customer GROUP BY c_mktsegment)"""
SYNTH_SQL = f"""SELECT id, segment, imp, clk, CASE WHEN {_draw_sql('age null')} % 100 >= 20 THEN {_draw_sql('age')} % 50 + 10 END AS age FROM (
  SELECT id, v AS segment, CASE WHEN {_draw_sql('imp')} % 11 < 1 THEN '0' ELSE '1' END AS imp, CASE WHEN {_draw_sql('clk')} % 3 < 1 THEN '0' ELSE '1' END AS clk
  FROM (SELECT CAST(c_custkey AS BIGINT) AS id FROM customer) JOIN ({SEGMENT_SQL}) ON {_draw_sql('segment')} % (SELECT COUNT(*) FROM customer) >= low AND {_draw_sql('segment')} % (SELECT COUNT(*) FROM customer) < high)
WHERE NOT (imp = '0' AND clk = '1')"""


def _synthetic(spark, sf_dir):
    customers = read(spark, sf_dir, "customer")
    ids = customers.select(F.col("c_custkey").alias("id"))
    ids = ml.draw_category(ids, "segment", ml.category_weights(customers, "c_mktsegment"), SEED)
    rows = ml.synthesize(ids, [
        ml.weighted("imp", {"0": 1, "1": 10}, SEED),
        ml.weighted("clk", {"0": 1, "1": 2}, SEED),
        ml.ranged("age", 10, 59, SEED, null_percent=20),
    ])
    return valid_funnel(rows)


@query("m17_synthetic_rows", SYNTH_SQL)
def synthetic_rows(spark, sf_dir):
    return _synthetic(spark, sf_dir)


@query(
    "e5_combine",
    f"SELECT c_custkey AS id, c_mktsegment AS segment, 'original' AS origin FROM customer UNION ALL SELECT id, segment, 'synthetic' FROM ({SYNTH_SQL})",
)
def combined(spark, sf_dir):
    original = read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_mktsegment AS segment", "'original' AS origin")
    return combine(original, _synthetic(spark, sf_dir).selectExpr("id", "segment", "'synthetic' AS origin"))
