"""Queries of the engine's own operators over the driver's tables, each with the same in SQL.

Floating results are rounded to a fixed number of places, as sums run in another order there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .functions.identity import rows_hash
from .functions.missing import is_missing
from .functions.shared import work_folder
from .operators.drift import ks_long, long_form, psi_long, quantile_grids
from .operators.gates import DuplicateGate, GateContext, MinRowsGate, PredicateGate, PropertyThresholdGate, SchemaGate, TargetMissingGate, TopKGate, UncertaintyGate, CompositeGate
from .operators.metrics import regression_metrics, slice_metrics, slice_names
from .operators.modelling import Featurizer, MeanBaseline, Trainer
from .operators.ordering import global_rank, running_totals, value_keys
from .operators.profile import chunk_drift, chunk_sizes, dominance_verdict, linear_r2, mask_funnel, scale_disparity, size_dominance, size_profile, target_correlations
from .operators.sampling import split_into_chunks, stratified_pool, systematic_sample
from .plans.triage import annotate_shortlist
from .plans.validation import apply_policy
from .streaming.arrival import windowed_drift, windowed_statistics

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str = ""):
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(c: Column | str, places: int = 6) -> Column:
    return F.round(c, places)


# ---- the shortlist: scored orders ----


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as candidates: the price is the score, its distance from the priority's mean (whole units) the uncertainty."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("score"), "o_orderpriority")
    means = orders.groupBy("o_orderpriority").agg(F.round(F.avg("score"), 0).alias("mean"))
    return orders.join(means, "o_orderpriority").select(F.col("o_orderkey").alias("row_id"), "score", F.round(F.abs(F.col("score") - F.col("mean")), 2).alias("unc"))


_SCORED = """orders_scored AS (
  SELECT o_orderkey AS row_id, o_totalprice AS score, round(abs(o_totalprice - m), 2) AS unc
  FROM orders JOIN (SELECT o_orderpriority, round(avg(o_totalprice), 0) AS m FROM orders GROUP BY o_orderpriority) USING (o_orderpriority))"""
_MASKS = """masks AS (
  SELECT row_id, score, unc, score >= 50000 AND score <= 350000 AS in_window, unc <= 120000 AS sure,
    row_number() OVER (ORDER BY score DESC, row_id) - 1 AS rank FROM orders_scored)"""

SHORTLIST = [PropertyThresholdGate("price", 50_000, 350_000), UncertaintyGate("price", 120_000), TopKGate("price", 5_000, largest=True)]


def decide(frame: DataFrame, gates) -> "GateDecision":  # noqa: F821
    return CompositeGate(gates).evaluate(GateContext(frame=frame, scores={"price": "score"}, uncertainty={"price": "unc"}))


@query(f"""WITH {_SCORED}, {_MASKS}
SELECT row_id, score, unc, rank, in_window AND sure AND rank < 5000 AS selected,
  CASE WHEN NOT in_window THEN 'threshold[price]' WHEN NOT sure THEN 'uncertainty[price]' WHEN rank >= 5000 THEN 'top_5000[price]' ELSE '' END AS dropped_by
FROM masks""")
def shortlist_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window, uncertainty ceiling and top-k with attribution and rank."""
    return annotate_shortlist(decide(scored_orders(spark, sf_dir), SHORTLIST))


@query(f"""WITH {_SCORED}, {_MASKS}, f AS (
  SELECT count(*) AS total, count(*) FILTER (in_window) AS a, count(*) FILTER (sure) AS b, count(*) FILTER (rank < 5000) AS c,
    count(*) FILTER (in_window AND sure AND rank < 5000) AS d FROM masks)
SELECT u.step::INT AS step, u.n AS "check", u.kept, f.total, f.total - u.kept AS dropped
FROM f, LATERAL (VALUES (0, 'threshold[price]', a), (1, 'uncertainty[price]', b), (2, 'top_5000[price]', c), (3, 'all', d)) u(step, n, kept)""")
def triage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    decision = decide(scored_orders(spark, sf_dir), SHORTLIST)
    return mask_funnel(decision.frame, dict(decision.masks))


@query(f"WITH {_SCORED}, {_MASKS} SELECT row_id, in_window AS kept FROM masks")
def threshold_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = scored_orders(spark, sf_dir)
    gate = PropertyThresholdGate("price", 50_000, 350_000)
    return frame.select("row_id", gate.mask(GateContext(frame=frame, scores={"price": "score"})).alias("kept"))


@query(f"WITH {_SCORED}, {_MASKS} SELECT row_id, sure, NOT sure AS acquired FROM masks")
def active_learning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An uncertainty ceiling and its inversion are complements."""
    frame = scored_orders(spark, sf_dir)
    ctx = GateContext(frame=frame, uncertainty={"price": "unc"})
    return frame.select("row_id", UncertaintyGate("price", 120_000).mask(ctx).alias("sure"), UncertaintyGate("price", 120_000, invert=True).mask(ctx).alias("acquired"))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank FROM orders")
def top_k_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full ranking behind a top-k check."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return global_rank(orders, value_keys(F.col("o_totalprice"), F.col("o_orderkey"), largest=True)).select("o_orderkey", "rank")


@query("SELECT o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS rank FROM orders) WHERE rank < 100")
def top_k_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hundred largest orders with their ranks."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    keys = value_keys(F.col("o_totalprice"), F.col("o_orderkey"), largest=True)
    return global_rank(orders.orderBy(*keys).limit(100), keys).select("o_orderkey", "o_totalprice", "rank")


# ---- validation ----


@query("SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY text) AS kept FROM documents")
def duplicate_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gate = DuplicateGate(0.5, ["text"])
    ctx = GateContext(frame=docs, row_id="doc_id")
    return gate.annotate(docs, ctx)[0].select("doc_id", gate.mask(ctx).alias("kept"))


@query("""SELECT d.doc_id, l.quality IS NOT NULL AND l.toxic IS NOT NULL AS kept
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def target_missing_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return frame.select("doc_id", TargetMissingGate(["quality", "toxic"], 1.0).mask(GateContext(frame=frame)).alias("kept"))


@query("SELECT source, count(*) AS n, count(*) >= 40 AS enough FROM documents GROUP BY source")
def min_rows_by_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"))
    return counts.withColumn("enough", F.col("n") >= MinRowsGate(40).min_rows)


@query("""SELECT event_type, count(*) AS n, count(*) FILTER (ok) AS n_ok, round(avg(ok::INT), 6) AS fraction
FROM (SELECT event_type, coalesce(json_valid(props), false) AS ok FROM events) GROUP BY event_type""")
def parseable_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parse check on JSON text."""
    events = table(spark, sf_dir, "events").select("event_type", "props")
    ok = events.select("event_type", F.coalesce(F.try_parse_json("props").isNotNull(), F.lit(False)).alias("ok"))
    return ok.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.col("ok").cast("long")).alias("n_ok"), rounded(F.avg(F.col("ok").cast("int"))).alias("fraction"))


_CHECKED = """d AS (
  SELECT documents.doc_id, text, labels.quality FROM documents LEFT JOIN labels ON labels.doc_id = documents.doc_id),
m AS (SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY text) AS first, quality IS NOT NULL AS labelled, length(text) >= 100 AS long FROM d)"""


def _checked(spark: SparkSession, sf_dir: str):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    frame = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    gates = [SchemaGate(["doc_id", "text"]), MinRowsGate(10), PredicateGate(lambda df: F.length("text") >= 100, 0.5, ["text"], "long_enough"), DuplicateGate(0.2, ["text"]), TargetMissingGate(["quality"], 1.0)]
    return frame, CompositeGate(gates, "validation").evaluate(GateContext(frame=frame, row_id="doc_id"))


@query(f"""WITH {_CHECKED} SELECT doc_id, first AND labelled AND long AS accepted,
  CASE WHEN NOT long THEN 'long_enough' WHEN NOT first THEN 'duplicates' WHEN NOT labelled THEN 'target_nan' ELSE '' END AS dropped_by FROM m""")
def policy_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and quarantined rows under the quarantine policy."""
    frame, decision = _checked(spark, sf_dir)
    outcome = apply_policy(frame, decision, "quarantine")
    kept = outcome.accepted.select("doc_id", F.lit(True).alias("accepted"), F.lit("").alias("dropped_by"))
    return kept.unionByName(outcome.quarantined.select("doc_id", F.lit(False).alias("accepted"), "dropped_by"))


@query(f"""WITH {_CHECKED}, n AS (SELECT count(*) AS n, count(*) FILTER (long) AS l, count(*) FILTER (first) AS f, count(*) FILTER (labelled) AS t FROM m)
SELECT u.* FROM n, LATERAL (VALUES ('schema', true), ('min_rows', n >= 10), ('long_enough', l >= 0.5 * n), ('duplicates', n - f <= 0.2 * n), ('target_nan', true)) u("check", verdict)""")
def validation_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check's verdict; none is skipped."""
    _, decision = _checked(spark, sf_dir)
    return spark.createDataFrame([(r.name, r.verdict) for r in decision.results], "check string, verdict boolean")


# ---- drift ----


def orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("price"), (F.col("o_custkey") % 97).cast("double").alias("bucket"))


_YEARS = "o AS (SELECT o_orderkey, year(o_orderdate)::INT AS year, o_totalprice AS price, (o_custkey % 97)::DOUBLE AS bucket FROM orders), y0 AS (SELECT min(year) AS y FROM o)"
_LONG = "l AS (SELECT year, 'price' AS \"column\", price AS value FROM o UNION ALL SELECT year, 'bucket', bucket FROM o), r AS (SELECT \"column\", value FROM l, y0 WHERE year = y)"
_KS = f"""WITH {_YEARS}, {_LONG},
n AS (SELECT year, "column", count(*) AS n FROM l GROUP BY ALL), nr AS (SELECT "column", count(*) AS n FROM r GROUP BY ALL),
c AS (SELECT year, "column", value, sum(s) AS s, sum(q) AS q FROM (
  SELECT year, "column", value, 1 AS s, 0 AS q FROM l UNION ALL SELECT year, r."column", value, 0, 1 FROM r JOIN n ON n."column" = r."column") GROUP BY ALL),
e AS (SELECT year, "column", sum(s) OVER w AS cs, sum(q) OVER w AS cq FROM c WINDOW w AS (PARTITION BY year, "column" ORDER BY value))
SELECT e.year, e."column", round(max(abs(cs / n.n - cq / nr.n)), 6) AS ks
FROM e JOIN n ON n.year = e.year AND n."column" = e."column" JOIN nr ON nr."column" = e."column" GROUP BY e.year, e."column\""""


@query(_KS)
def ks_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every year's columns against the first year, in one job."""
    orders = orders_by_year(spark, sf_dir)
    first = orders.join(F.broadcast(orders.agg(F.min("year").alias("year"))), "year")
    columns = ["price", "bucket"]
    return ks_long(long_form(orders, columns, ["year"]), long_form(first, columns), ["year"]).withColumn("ks", rounded("ks"))


@query(_KS.replace('e."column", round(max', '\'price\' AS "column", round(max').replace("GROUP BY e.year, e.\"column\"", "WHERE e.\"column\" = 'price' GROUP BY e.year"))
def chunk_drift_of_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(spark, sf_dir)
    first = orders.join(F.broadcast(orders.agg(F.min("year").alias("year"))), "year")
    return chunk_drift(orders, first, ["price"], "year").withColumn("ks", rounded("ks"))


@query(f"""WITH {_YEARS}, {_LONG},
e AS (SELECT "column", list_sort(list_distinct(quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]))) AS e, count(*) AS n FROM r GROUP BY ALL),
s AS (SELECT year, l."column", len(list_filter(e.e, lambda x: x <= l.value)) AS b FROM l JOIN e ON e."column" = l."column"),
q AS (SELECT r."column", len(list_filter(e.e, lambda x: x <= r.value)) AS b FROM r JOIN e ON e."column" = r."column"),
n AS (SELECT year, "column", count(*) AS n FROM s GROUP BY ALL),
f AS (SELECT n.year, n."column", k.b, n.n, e.n AS nr FROM n JOIN e ON e."column" = n."column", unnest(range(0, len(e.e) + 1)) AS k(b)),
p AS (SELECT f.year, f."column", f.b, greatest(count(s.b) / any_value(f.n), 1e-6) AS p FROM f LEFT JOIN s ON s.year = f.year AND s."column" = f."column" AND s.b = f.b GROUP BY f.year, f."column", f.b),
x AS (SELECT f.year, f."column", f.b, greatest(count(q.b) / any_value(f.nr), 1e-6) AS q FROM f LEFT JOIN q ON q."column" = f."column" AND q.b = f.b GROUP BY f.year, f."column", f.b)
SELECT p.year, p."column", round(sum((p - q) * ln(p / q)), 6) AS psi FROM p JOIN x ON x.year = p.year AND x."column" = p."column" AND x.b = p.b GROUP BY p.year, p."column\"""")
def psi_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_by_year(spark, sf_dir)
    first = orders.join(F.broadcast(orders.agg(F.min("year").alias("year"))), "year")
    columns = ["price", "bucket"]
    return psi_long(long_form(orders, columns, ["year"]), long_form(first, columns), ["year"]).withColumn("psi", rounded("psi"))


@query("""WITH l AS (SELECT 'price' AS "column", o_totalprice AS v FROM orders UNION ALL SELECT 'bucket', (o_custkey % 97)::DOUBLE FROM orders),
g AS (SELECT "column", quantile_cont(v, list_transform(range(0, 401), lambda k: k / 400)) AS q, avg(v) AS m, stddev_pop(v) AS s FROM l GROUP BY "column")
SELECT "column", u.k::INT - 1 AS k, round(u.v, 6) AS quantile, round(m, 6) AS mean, round(s, 6) AS std FROM g, unnest(q) WITH ORDINALITY AS u(v, k)""")
def reference_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid that a drift reference is frozen to."""
    grids = quantile_grids(orders_by_year(spark, sf_dir), ["price", "bucket"])
    return grids.select("column", F.posexplode("quantiles").alias("k", "v"), rounded("mean").alias("mean"), rounded("std").alias("std")).select("column", "k", rounded("v").alias("quantile"), "mean", "std")


@query("""SELECT o_orderdate, n, sum(n) OVER (ORDER BY o_orderdate)::BIGINT AS so_far FROM (SELECT o_orderdate, count(*) AS n FROM orders GROUP BY o_orderdate)""")
def cumulative_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals by value without a global window."""
    counts = table(spark, sf_dir, "orders").groupBy("o_orderdate").agg(F.count("*").alias("n"))
    return running_totals(counts, [F.col("o_orderdate")], {"so_far": F.col("n")})


# ---- metrics ----


def price_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two predictions of three numbers of each line item: its price by its quantity, and constants."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t")
    )
    each = F.array(
        F.struct(F.lit("price").alias("target"), F.col("price").alias("y"), (F.col("q") * 1500).alias("pred"), F.lit(38000.0).alias("old")),
        F.struct(F.lit("discount").alias("target"), F.col("d").alias("y"), F.lit(0.05).alias("pred"), F.lit(0.04).alias("old")),
        F.struct(F.lit("tax").alias("target"), F.col("t").alias("y"), F.lit(0.04).alias("pred"), F.lit(0.02).alias("old")),
    )
    return lines.select("part", "q", F.inline(each))


_PRED = """p AS (
  SELECT l_partkey AS part, l_quantity AS q, u.target, u.y, u.pred, u.old FROM lineitem,
  LATERAL (VALUES ('price', l_extendedprice, l_quantity * 1500, 38000.0::DOUBLE), ('discount', l_discount, 0.05::DOUBLE, 0.04::DOUBLE), ('tax', l_tax, 0.04::DOUBLE, 0.02::DOUBLE)) u(target, y, pred, old))"""


@query(f"""WITH {_PRED} SELECT target, count(*) AS n, round(avg(abs(pred - y)), 8) AS mae, round(sqrt(avg((pred - y) ^ 2)), 8) AS rmse,
round(1 - sum((pred - y) ^ 2) / (var_pop(y) * count(*)), 8) AS r2, round(stddev_pop(y), 8) AS std FROM p GROUP BY target""")
def regression_metrics_by_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = regression_metrics(price_predictions(spark, sf_dir))
    return found.select("target", "n", *(rounded(c, 8).alias(c) for c in ("mae", "rmse", "r2", "std")))


_SLICES = {"quantity": {"column": "q", "bins": [0, 10, 25, 60]}}
_SLICED = """s AS (SELECT *, CASE WHEN q >= 0 AND q < 10 THEN 'quantity[0-10)' WHEN q >= 10 AND q < 25 THEN 'quantity[10-25)' WHEN q >= 25 AND q < 60 THEN 'quantity[25-60)' END AS slice FROM p),
d AS (SELECT target, stddev_pop(y) AS sd FROM p GROUP BY target)"""


def _sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = price_predictions(spark, sf_dir)
    return long.withColumn("slices", slice_names(_SLICES, long.columns))


@query(f"""WITH {_PRED}, {_SLICED}, t AS (SELECT slice, s.target, avg(abs(pred - y)) / any_value(sd) AS e, count(*) AS n FROM s JOIN d ON d.target = s.target WHERE slice IS NOT NULL GROUP BY slice, s.target)
SELECT slice, round(avg(e), 6) AS normalized_mae, max(n) AS n FROM t GROUP BY slice HAVING max(n) >= 20""")
def slice_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_metrics(_sliced(spark, sf_dir)).withColumn("normalized_mae", rounded("normalized_mae"))


@query(f"""WITH {_PRED}, {_SLICED}, t AS (
  SELECT slice, s.target, avg(abs(pred - y)) / any_value(sd) AS new, avg(abs(old - y)) / any_value(sd) AS old FROM s JOIN d ON d.target = s.target WHERE slice IS NOT NULL GROUP BY slice, s.target)
SELECT slice, round((avg(new) - avg(old)) / avg(old), 6) AS change, (avg(new) - avg(old)) / avg(old) > 0.1 AS regressed FROM t GROUP BY slice""")
def slice_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = _sliced(spark, sf_dir)
    new = slice_metrics(long).select("slice", F.col("normalized_mae").alias("new"))
    old = slice_metrics(long.withColumn("pred", F.col("old"))).select("slice", F.col("normalized_mae").alias("old"))
    change = (F.col("new") - F.col("old")) / F.col("old")
    return new.join(old, "slice").select("slice", rounded(change).alias("change"), (change > 0.1).alias("regressed"))


@query("""WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS a, regr_intercept(o_totalprice, o_custkey) AS b, avg(o_totalprice) AS m FROM orders)
SELECT round(avg(abs(o_totalprice - m)), 4) AS baseline_mae, round(avg(abs(o_totalprice - (a * o_custkey + b))), 4) AS candidate_mae FROM orders, f""")
def baseline_vs_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean predictor against a straight line."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    fit = orders.agg(F.regr_slope("o_totalprice", "o_custkey").alias("a"), F.regr_intercept("o_totalprice", "o_custkey").alias("b"), F.avg("o_totalprice").alias("m"))
    both = orders.crossJoin(F.broadcast(fit))  # one row of coefficients
    return both.agg(
        rounded(F.avg(F.abs(F.col("o_totalprice") - F.col("m"))), 4).alias("baseline_mae"),
        rounded(F.avg(F.abs(F.col("o_totalprice") - (F.col("a") * F.col("o_custkey") + F.col("b")))), 4).alias("candidate_mae"),
    )


# ---- sampling ----


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_id"), F.col("p_size").alias("size"))


_POOL = """c AS (SELECT p_size AS size, count(*) AS n FROM part WHERE p_size > 0 GROUP BY p_size),
k AS (SELECT count(*) AS sizes, greatest(1, 600 // count(*)) AS share FROM c),
q0 AS (SELECT size, n, least(share, n) AS q FROM c, k),
l AS (SELECT 600 - sum(q) AS left_over, sum(n - q) AS spare FROM q0),
q AS (SELECT size, q + CASE WHEN left_over > 0 AND spare > 0 THEN least(n - q, round_even(left_over * (n - q) / spare, 0)::BIGINT) ELSE 0 END AS q FROM q0, l),
r AS (SELECT p_partkey AS row_id, p_size AS size, row_number() OVER (PARTITION BY p_size ORDER BY sha256('0#' || p_partkey), p_partkey) AS d FROM part WHERE p_size > 0),
pool AS (SELECT row_id, r.size, row_number() OVER (ORDER BY r.size, row_id) - 1 AS position FROM r JOIN q ON q.size = r.size WHERE d <= q)"""


@query(f"WITH {_POOL} SELECT row_id, size, position FROM pool")
def stratified_pool_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_pool(_parts(spark, sf_dir), "size", 600, "0")


_SPLIT = f"""{_POOL}, n AS (SELECT count(*) AS n FROM pool),
ch AS (SELECT pool.*, len(list_filter(range(1, 6), lambda k: position >= trunc(n * k / 6))) AS chunk FROM pool, n),
g AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY sha256('0/golden#' || row_id), row_id) AS d, count(*) OVER (PARTITION BY chunk) AS size_of_chunk FROM ch)"""


@query(f"WITH {_SPLIT} SELECT row_id, size, position, chunk::INT AS chunk, d <= round_even(size_of_chunk * 0.15, 0) AS golden FROM g")
def chunk_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A size ramp in six chunks with a golden sample of each."""
    return split_into_chunks(_parts(spark, sf_dir), "size", 600, 6, 0.15, "0").select("row_id", "size", "position", "chunk", "golden")


@query(f"WITH {_SPLIT} SELECT chunk::INT AS chunk, count(*) AS n, round(avg(size), 6) AS mean_size, min(size) AS min_size, max(size) AS max_size FROM g WHERE NOT d <= round_even(size_of_chunk * 0.15, 0) GROUP BY chunk")
def sizes_of_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split_into_chunks(_parts(spark, sf_dir), "size", 600, 6, 0.15, "0").filter("not golden")
    return chunk_sizes(rows, "size", "chunk").withColumn("mean_size", rounded("mean_size"))


@query("""WITH p AS (SELECT p_partkey - min(p_partkey) OVER () AS row_id, p_size AS size FROM part), k AS (SELECT greatest(1, count(*) // 150) AS step FROM p)
SELECT row_id, size FROM p, k WHERE row_id % step = 0 AND row_id < step * 150""")
def systematic_sample_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every k-th part; this is a sampling operator."""
    parts = _parts(spark, sf_dir)
    first = parts.agg(F.min("row_id").alias("first"))
    return systematic_sample(parts.crossJoin(F.broadcast(first)).withColumn("row_id", F.col("row_id") - F.col("first")).drop("first"), 150)


# ---- profiles ----


@query("SELECT p_size AS size, count(*) AS n, min(p_partkey) AS first_row, round(count(*) / (SELECT count(*) FROM part), 9) AS fraction FROM part GROUP BY p_size")
def size_profile_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return size_profile(_parts(spark, sf_dir), "size").withColumn("fraction", rounded("fraction", 9))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINES = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS v, l_quantity AS x FROM lineitem" for c in _NUMBERS)


@query(f"""WITH l AS ({_LINES}), s AS (SELECT "column", avg(v) AS m, stddev_pop(v) AS sd, avg(abs(v)) AS a, max(v) - min(v) AS r FROM l GROUP BY "column")
SELECT "column", round(m, 6) AS mean, round(sd, 6) AS std, round(a, 6) AS mean_abs, round(r, 6) AS range, round_even(log10(sd / (SELECT min(sd) FROM s)), 2) AS orders FROM s""")
def scale_disparity_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scale_disparity(table(spark, sf_dir, "lineitem"), _NUMBERS)
    return found.select("column", *(rounded(c).alias(c) for c in ("mean", "std", "mean_abs", "range")), "orders")


@query(f'WITH l AS ({_LINES}) SELECT "column", round(regr_r2(v, x), 6) AS r2 FROM l GROUP BY "column"')
def size_dominance_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return size_dominance(table(spark, sf_dir, "lineitem"), _NUMBERS, "l_quantity").withColumn("r2", rounded("r2"))


@query(" UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for k, a in enumerate(_NUMBERS) for b in _NUMBERS[k + 1 :]))
def target_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_correlations(table(spark, sf_dir, "lineitem"), _NUMBERS).withColumn("r", rounded("r"))


@query("""WITH s AS (SELECT corr(l_extendedprice, l_quantity) AS a, corr(l_extendedprice, l_discount) AS b, corr(l_quantity, l_discount) AS c FROM lineitem)
SELECT 'l_extendedprice' AS "column", round((a * a + b * b - 2 * a * b * c) / (1 - c * c), 6) AS r2,
  CASE WHEN (a * a + b * b - 2 * a * b * c) / (1 - c * c) > 0.99 THEN 'atom counting' WHEN (a * a + b * b - 2 * a * b * c) / (1 - c * c) > 0.9 THEN 'mostly size' ELSE 'real chemistry' END AS verdict FROM s""")
def multi_ols_r2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares on two inputs from sums of products."""
    found = linear_r2(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], ["l_quantity", "l_discount"])
    return spark.createDataFrame([(c, round(float(x), 6), dominance_verdict(x)) for c, x in found.items()], "column string, r2 double, verdict string")


# ---- chunks, identities, streams ----


_ROWS_HASH = """'sha256:' || substr(sha256(count(*) || '#' || sum(('0x' || substr(sha256(text), 1, 12))::BIGINT) || '#' || sum(('0x' || substr(sha256(text), 13, 12))::BIGINT)), 1, 16)"""


@query(f"SELECT source, {_ROWS_HASH} AS data_version FROM documents GROUP BY source")
def chunk_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A content hash of each source, whatever the order of its rows."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(rows_hash(F.col("text")).alias("data_version"))


@query("""SELECT event_id, value IS NOT NULL AND NOT isnan(value) AND value >= 10 AS kept FROM events""")
def not_missing_above(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select("event_id", (~is_missing(events, "value") & (F.col("value") >= 10)).alias("kept"))


@query("""WITH r AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events),
w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS start, event_type, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std FROM events GROUP BY ALL)
SELECT start, event_type, n, round(mean, 6) AS mean, round(std, 6) AS std, round((mean - m) / CASE WHEN s > 0 THEN s ELSE 1 END, 6) AS shift FROM w, r""")
def windowed_event_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of an event stream against the whole; an extension."""
    events = table(spark, sf_dir, "events")
    whole = events.agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s")).first()
    found = windowed_drift(windowed_statistics(events, "ts", "value", "1 day", by=("event_type",)), whole.m or 0.0, whole.s or 0.0)
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", *(rounded(c).alias(c) for c in ("mean", "std", "shift")))


@query("""SELECT 'price' AS target, round(avg(o_totalprice), 6) AS mean, round(stddev_pop(o_totalprice), 6) AS std FROM orders
UNION ALL SELECT 'bucket', round(avg(o_custkey % 97), 6), round(stddev_pop(o_custkey % 97), 6) FROM orders""")
def mean_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mean predictor learns."""
    model = MeanBaseline(["price", "bucket"]).fit(orders_by_year(spark, sf_dir))
    return spark.createDataFrame([(t, round(model.means[t], 6), round(model.stds[t], 6)) for t in model.targets], "target string, mean double, std double")


@query()
def forest_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest on array features, its mean over trees and their spread."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row_id"), "embedding", F.col("label").cast("double").alias("y"))
    featurizer = Featurizer("columns", columns=("embedding",)).fit(rows)
    model = Trainer(params={"n_estimators": 10, "max_depth": 6}).fit(featurizer.transform(rows), ["y"], featurizer.version)
    return model.predict(featurizer.transform(rows), with_uncertainty=True).select("row_id", "pred_y", "unc_y")


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY ALL""")
def streamed_event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows of the event table read as a stream until it is used up."""
    path = work_folder(spark, "windows")
    stream = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parq*")
    windows = windowed_statistics(stream, "ts", "value", "1 hour", watermark="1 hour")
    running = windows.writeStream.outputMode("complete").option("checkpointLocation", f"{path}/progress").trigger(availableNow=True)
    running.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{path}/table")).start().awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{path}/table").select(F.col("start").cast("timestamp_ntz").alias("start"), "n", rounded("mean").alias("mean"))
