"""Named queries over a driver data folder: the engine's operators, end to end.

The first query of a folder cleans and validates the whole driver tables and stores the
annotated tables in the shared folder; all queries of the application then read those, as
reports read loaded tables in production.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfmark import schemas
from shelfmark.functions.exprs import as_double, money_as_double
from shelfmark.operators import churn, clean, facts, measures, quality, risk, rfm, star, validate
from shelfmark.operators.features import (
    ChurnWindow, churn_dataset, churn_metadata, customer_feature_view, customer_features,
    labelled_cohort,
)
from shelfmark.operators.ranking import percent_rank_average
from shelfmark.plans import reports
from shelfmark.plans.customer_analytics import ChurnPlan, customer_analytics, scored_customers
from shelfmark.plans.etl import Etl, audit_log_row, reconciliation, run_audit
from shelfmark.session import CODEC, durable, freed_shuffles, fresh_dir, stored, wide_shuffles
from shelfmark.sources import readers, writers
from shelfmark.sources.adapter import Tables, raw_tables

RUN_TIMESTAMP = "2001-08-02 00:00:00"
SNAPSHOT = "2001-08-01"
RECENT_FROM = "2001-05-03"
TRAIN = ChurnWindow("2001-02-02", "2001-02-03", "2001-05-03")
TEST = ChurnWindow("2001-05-03", "2001-05-04", "2001-08-01")
PLAN = ChurnPlan(TRAIN, TEST)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


RETAIL = ("region", "nation", "customer", "part", "orders", "lineitem")


def _state(spark: SparkSession, sf_dir: str) -> int:
    """A number that changes with the path, length or time of any input file. The file system
    lists them; no job is run."""
    found, conf = [], spark._jsc.hadoopConfiguration()
    for t in RETAIL:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hash(tuple(sorted(found)))


def stored_raw(spark: SparkSession, sf_dir: str) -> Tables:
    """The raw tables, extracted once: later passes over them read only the columns they need."""
    out, raw = fresh_dir(spark, "raw"), raw_tables(spark, sf_dir).items()
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()  # from the files' footers
    with wide_shuffles(spark, lines), freed_shuffles(spark), ThreadPoolExecutor(3) as jobs:
        return Tables(*jobs.map(lambda name: stored(raw[name], f"{out}/{name}", CODEC), raw))


@lru_cache(maxsize=4)
def _etl(application: str, state: int, spark: SparkSession, sf_dir: str) -> Etl:
    return Etl(stored_raw(spark, sf_dir), RUN_TIMESTAMP)


def etl_of(spark: SparkSession, sf_dir: str) -> Etl:
    """The cleaned and validated tables of a folder, built once per application and state of its
    files."""
    return _etl(spark.sparkContext.applicationId, _state(spark, sf_dir), spark, sf_dir)


@lru_cache(maxsize=4)
def _scored(application: str, state: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_customers(etl_of(spark, sf_dir).priced)
    return stored(scored, fresh_dir(spark, "scored"))


def scored_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with features, segment and risk, stored once per application."""
    return _scored(spark.sparkContext.applicationId, _state(spark, sf_dir), spark, sf_dir)


def _add(name: str, build: Callable[[Etl], DataFrame]) -> None:
    """Register a query over the ETL tables; money columns leave as doubles."""
    QUERIES[name] = lambda spark, sf_dir: money_as_double(build(etl_of(spark, sf_dir)))


def _add_valid(name: str, build: Callable[[Tables], DataFrame]) -> None:
    _add(name, lambda etl: build(etl.priced))


def _add_scored(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: money_as_double(build(scored_of(spark, sf_dir)))


# ------------------------------------------------------------- cleaning and validation
_add("cln_customers", lambda e: e.cleaned.customers)
_add("cln_products", lambda e: e.cleaned.products)


def _seq_as_text(orders: DataFrame) -> DataFrame:
    """The wide sequence number as text: a double could not hold it."""
    return orders.withColumn("src_seq", F.col("src_seq").cast("string"))


_add("cln_orders", lambda e: _seq_as_text(e.cleaned.orders))
_add("cln12_customer_stats",
     lambda e: clean.customer_clean_stats(e.cleaned.customers, e.raw.customers))
_add("cln12_product_stats", lambda e: clean.product_clean_stats(e.cleaned.products))
_add("cln12_order_stats", lambda e: clean.order_clean_stats(e.cleaned.orders))
_add("cln12_status_distribution", lambda e: clean.status_distribution(e.cleaned.orders))

def _annotated(e: Etl, name: str) -> DataFrame:
    return e.checked.items()[name].select(validate.SEQ, *schemas.CLEAN[name].names, validate.REASON)


_add("val1_customers", lambda e: _annotated(e, "customers"))
_add("val3_products", lambda e: _annotated(e, "products"))
_add("val4_orders", lambda e: _seq_as_text(_annotated(e, "orders")))
_add("val6_valid_orders", lambda e: e.valid.orders)
_add("val7_dead_letters", lambda e: e.rejected)
_add("val8_reason_counts", lambda e: e.reasons)
_add("val9_table_stats", lambda e: e.stats)
_add("val10_declared_constraints", lambda e: validate.declared_constraints(e.checked.items()))

# ------------------------------------------------------------------------------- facts
_add_valid("fct1_order_view", lambda t: facts.order_analytics(t.orders, t.customers, t.products))
_add_valid("fct2_star_fact", lambda t: facts.fact_orders(t.orders, t.products))

# ----------------------------------------------------------------------------- reports
_add_valid("rpt01_executive_scorecard", reports.executive_scorecard)
_add_valid("rpt02_monthly_trend", reports.monthly_trend)
_add_valid("rpt03_annual_trend", reports.annual_trend)
_add_valid("rpt04_status_funnel", reports.status_funnel)
_add_valid("rpt05_payment_mix", reports.payment_mix)
_add_valid("rpt06_category_matrix", reports.category_matrix)
_add_valid("rpt07_top_products", reports.top_products)
_add_valid("rpt08_bottom_products", reports.bottom_products)
_add_valid("rpt09_product_pareto", reports.product_pareto)
_add_valid("rpt10_top_completed_products", reports.top_completed_products)
_add_valid("rpt11_customer_lifecycle", reports.customer_lifecycle)
_add_valid("rpt12_customer_ltv", lambda t: reports.customer_ltv(t, SNAPSHOT))
_add_valid("rpt13_customer_pareto", reports.customer_pareto)
_add_valid("rpt14_top_customers", reports.top_customers)
_add_valid("rpt15_dormant_customers", lambda t: reports.dormant_customers(t, SNAPSHOT))
_add_valid("rpt16_activity_cohorts", lambda t: reports.activity_cohorts(t, SNAPSHOT))
_add_valid("rpt17_leakage", reports.leakage)
_add_valid("rpt18_leakage_by_category", reports.leakage_by_category)
_add("rpt19_dq_throughput", lambda e: reports.dq_throughput(e.valid, e.rejected))
_add("rpt20_dlq_root_causes", lambda e: reports.dlq_root_causes(e.rejected))
_add("rpt22_run_scorecard", lambda e: reports.run_scorecard(e.stats, e.reasons))
_add_valid("rpt23_population_scorecard", lambda t: reports.population_scorecard(
    customer_features(t.orders, t.customers, t.products)))
_add_valid("rpt24_seasonal_averages", reports.seasonal_averages)
_add_scored("rpt25_customer_table", lambda s: reports.customer_table(
    s.select(
        "customer_id", "name", "age", "state", "customer_segment", "risk_level", "total_revenue"),
    segments=["Champions", "At Risk", "Cannot Lose Them"],
    risk_levels=["HIGH", "CRITICAL", "LOW"],
    age_groups=["25-34", "35-44", "45-54"]))

# ---------------------------------------------------------------------------- features
_add_valid("fea_customer_features",
           lambda t: customer_features(t.orders, t.customers, t.products))
_add_valid("fea1_features_at_cutoff",
           lambda t: customer_features(t.orders, t.customers, t.products, cutoff=TEST.cutoff))
_add_valid("fea16_feature_view", lambda t: customer_feature_view(
    t.orders, t.customers, t.products, SNAPSHOT, RECENT_FROM))
_add_valid("fea17_churn_dataset",
           lambda t: churn_dataset(t.orders, t.customers, t.products, TEST))
_add_valid("fea17_train_dataset",
           lambda t: churn_dataset(t.orders, t.customers, t.products, TRAIN))
_add_valid("fea17_churn_metadata", lambda t: churn_metadata(
    churn_dataset(t.orders, t.customers, t.products, TEST), TEST))
_add_valid("fea18_labelled_cohort",
           lambda t: labelled_cohort(t.orders, t.customers, t.products, TEST))

# ----------------------------------------------------------------------- segments, risk
_SEGMENT_COLUMNS = (
    "customer_id", "r_score", "f_score", "m_score", "rfm_score", "customer_segment",
)
_add_scored("rfm1_scores", lambda s: s.select(*_SEGMENT_COLUMNS))
_add_scored("rfm4_segment_summary", rfm.segment_summary)
_add_scored("rfm5_concentration", rfm.segment_concentration)
_add_scored("rfm6_segment_profit", rfm.segment_profit)
_add_scored("rsk1_scores", lambda s: s.select(
    "customer_id", "risk_score", "risk_level", "key_risk_driver", "recommended_action"))
_add_scored("rsk5_tier_summary", risk.tier_summary)
_add_scored("rsk6_exposure", risk.exposure)
_add_scored("rsk7_intervention_list", risk.intervention_list)
_add_scored("ag13_segment_by_tier", risk.segment_by_tier)
_add_valid("wn6_customer_tiles", reports.customer_tiles)
_add_valid("wn7_percent_rank", lambda t: percent_rank_average(
    durable(customer_features(t.orders, t.customers, t.products).select(
        "customer_id", "total_revenue")), "total_revenue"))

# --------------------------------------------------------------------------------- star


def _dates(t: Tables) -> DataFrame:
    return star.date_dimension_of(t.orders)


_add_valid("str1_dim_date", _dates)
_add_valid("str2_dim_products", lambda t: star.dim_products(t.products))
_add_valid("str3_dim_customers", lambda t: star.dim_customers(t.customers))
_add_valid("str6_reconciliation", lambda t: star.star_reconciliation(
    facts.fact_orders(t.orders, t.products), star.dim_customers(t.customers),
    star.dim_products(t.products), _dates(t)))

# ----------------------------------------------------------------------------- measures
_add_valid("msr_total", lambda t: measures.measures(
    facts.fact_orders(t.orders, t.products), t.customers))
_add_valid("msr_by_month", lambda t: measures.measures(
    facts.fact_orders(t.orders, t.products).withColumn(
        "month_year", F.date_format("order_date", "yyyy-MM")), t.customers, ["month_year"]))
_add_valid("msr_by_category", lambda t: measures.measures(
    facts.fact_orders(t.orders, t.products).join(
        t.products.select("product_id", "category"), "product_id"), t.customers, ["category"]))
_add_valid("msr_by_state", lambda t: measures.measures(
    facts.fact_orders(t.orders, t.products).join(
        t.customers.select("customer_id", "state"), "customer_id"), t.customers, ["state"]))
_add_valid("msr19_time_intelligence",
           lambda t: measures.time_intelligence(facts.fact_orders(t.orders, t.products)))
_add_scored("msr23_risk_measures", measures.risk_measures)

# ------------------------------------------------------------------------- data quality
IDS = validate.ID_COLUMNS
_add("dq1_table_profile", lambda e: quality.table_profile(e.raw.items()))
_add("dq2_null_profile", lambda e: quality.null_profile(e.raw.items()))
_add("dq3_duplicates", lambda e: quality.duplicate_profile(e.raw.items(), IDS))
_add("dq4_quantity_profile", lambda e: quality.quantity_profile(e.raw.orders))
_add("dq5_raw_revenue", lambda e: quality.raw_revenue(e.raw.orders, e.raw.products))
_add("dq6_distributions", lambda e: quality.order_distributions(e.raw.orders))
_add("dq7_foreign_keys", lambda e: quality.foreign_key_audits(e.raw))
_add("dq8_temporal_violations",
     lambda e: quality.temporal_violations(e.raw.orders, e.raw.customers))
_add("dq9_reconciliation", lambda e: reconciliation(e, facts.order_analytics(
    e.priced.orders, e.valid.customers, e.valid.products)))
_add("dq10_orphan_root_causes", lambda e: quality.orphan_root_causes(e.raw, e.valid.products))
_add("dq11_negative_quantities", lambda e: quality.negative_quantities(e.raw.orders))
_add("dq12_margin_divergence", lambda e: quality.margin_divergence(e.valid.products))
_add("dq13_dead_letter_completeness", lambda e: quality.dead_letter_completeness(e.rejected))
_add("dq14_status_units", lambda e: quality.status_units(e.valid.orders))
_add("dq14_refund_quantities", lambda e: quality.refund_quantities(e.valid.orders))
_add("dq15_payload_fields", lambda e: quality.payload_fields(e.rejected))
_add("dq16_revenue_identities", lambda e: quality.revenue_identities(
    facts.order_lines(e.priced.orders, e.valid.products)))
_add("dq17_cross_totals", lambda e: quality.cross_totals(
    facts.order_lines(e.priced.orders, e.valid.products)))
_add("dq18_quarantine_isolation",
     lambda e: quality.quarantine_isolation(e.valid, e.rejected, IDS))
_add("dq19_star_integrity", lambda e: quality.star_integrity(
    facts.fact_orders(e.priced.orders, e.valid.products),
    e.valid.customers, e.valid.products, _dates(e.valid),
    customer_features(e.priced.orders, e.valid.customers, e.valid.products)))
_add("dq20_view_completeness", lambda e: quality.view_completeness(facts.order_analytics(
    e.priced.orders, e.valid.customers, e.valid.products)))
_add("dq21_feature_bounds", lambda e: quality.feature_bounds(customer_features(
    e.priced.orders, e.valid.customers, e.valid.products, cutoff=TEST.cutoff), TEST.cutoff))
_add_scored("dq22_segment_domains", rfm.segment_domain_checks)
_add("sl5_dead_letter_samples", lambda e: quality.dead_letter_samples(e.rejected))


# -------------------------------------------------------------------------- churn models
def _rule_scores(t: Tables) -> DataFrame:
    """The rule score of the test cohort read as a probability, next to the true label."""
    cohort = risk.risk_scores(churn_dataset(t.orders, t.customers, t.products, TEST))
    return durable(cohort.select(
        "customer_id", churn.LABEL, (as_double("risk_score") / 100.0).alias(churn.PROBABILITY)))


_add_valid("chn5_rule_score_metrics",
           lambda t: churn.classification_metrics(_rule_scores(t)))
_add_valid("chn6_rule_score_thresholds", lambda t: churn.threshold_table(_rule_scores(t)))


@lru_cache(maxsize=4)
def _cohorts_of(application: str, state: int, spark: SparkSession, sf_dir: str):
    return tuple(churn.training_rows(df) for df in PLAN.datasets(etl_of(spark, sf_dir).priced))


@lru_cache(maxsize=8)
def _model_of(application: str, state: int, spark: SparkSession, sf_dir: str, which: str):
    fit = {"logistic": churn.fit_logistic, "forest": churn.fit_forest}[which]
    return fit(_cohorts(spark, sf_dir)[0])


def _cohorts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of a folder, stored once per application."""
    return _cohorts_of(spark.sparkContext.applicationId, _state(spark, sf_dir), spark, sf_dir)


def _model(spark: SparkSession, sf_dir: str, which: str):
    """A fitted model of a folder, shared by the model queries of one application."""
    return _model_of(spark.sparkContext.applicationId, _state(spark, sf_dir), spark, sf_dir, which)


def _register(name: str):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def _test_scores(spark: SparkSession, sf_dir: str, which: str) -> DataFrame:
    test = _cohorts(spark, sf_dir)[1]
    return durable(churn.probability(_model(spark, sf_dir, which), test, "customer_id", churn.LABEL))


@_register("chn3_logistic_metrics")
def _logistic_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.classification_metrics(_test_scores(spark, sf_dir, "logistic"))


@_register("chn4_forest_metrics")
def _forest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.classification_metrics(_test_scores(spark, sf_dir, "forest"))


@_register("chn6_logistic_thresholds")
def _logistic_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.threshold_table(_test_scores(spark, sf_dir, "logistic"))


@_register("chn7_coefficients")
def _coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.coefficients(_model(spark, sf_dir, "logistic"), spark)


@_register("chn7_importances")
def _importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.importances(_model(spark, sf_dir, "forest"), spark)


def _analytics(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_of(spark, sf_dir)
    return customer_analytics(scored, churn.score_population(_model(spark, sf_dir, "logistic"), scored))


@_register("chn8_population_scores")
def _population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _analytics(spark, sf_dir).select("customer_id", churn.PROBABILITY)


@_register("chn9_customer_analytics")
def _chn9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table; whether the model's probability is one stands for it here, and
    ``chn8_population_scores`` has its values."""
    return money_as_double(_flagged(_analytics(spark, sf_dir)))


def _flagged(analytics: DataFrame) -> DataFrame:
    valid = F.coalesce(F.col(churn.PROBABILITY).between(0, 1), F.lit(False))
    return analytics.withColumn("has_probability", valid).drop(churn.PROBABILITY)


@_register("chn2_scaler")
def _scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.scaler_table(_cohorts(spark, sf_dir)[0], _model(spark, sf_dir, "logistic"))


@_register("chn3_optimality")
def _optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return churn.optimality(_model(spark, sf_dir, "logistic"), _cohorts(spark, sf_dir)[0])


@_register("chn4_forest_table")
def _forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forest as a table of split conditions against the model, on all customers."""
    model, scored = _model(spark, sf_dir, "forest"), scored_of(spark, sf_dir)
    nodes = stored(churn.forest_nodes(model, spark), fresh_dir(spark, "nodes"))
    own = churn.probability(model, scored, "customer_id")
    trees = nodes.agg(F.count_distinct("tree")).scalar()
    return churn.disagreements(own, churn.score_by_nodes(nodes, scored, "customer_id"), "customer_id").withColumn("trees", trees)


@_register("chn8_score_expression")
def _score_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logistic model as an expression against the model, on all customers."""
    model, scored = _model(spark, sf_dir, "logistic"), scored_of(spark, sf_dir)
    by_hand = churn.model_matrix(scored, "customer_id").select("customer_id", churn.logistic_score(model).alias(churn.PROBABILITY))
    return churn.disagreements(churn.probability(model, scored, "customer_id"), by_hand, "customer_id")


@_register("snk5_customer_analytics")
def _snk5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer table written as catalog table and from there as file; the table read back, with
    the model's probability reduced to whether it is one."""
    out = fresh_dir(spark, "analytics")
    name = writers.save_table(_analytics(spark, sf_dir), f"{_table_prefix()}customer_analytics", f"{out}/table")
    writers.write_csv(spark.table(name), f"{out}/customer_analytics.csv")
    return money_as_double(_flagged(spark.table(name)))


@_register("msr26_scored_risk_measures")
def _msr26(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk measures of the scored table; its mean probability is compared with the mean that the
    model's expression gives, and must lie between 0 and 1."""
    measured = measures.risk_measures(_analytics(spark, sf_dir))
    by_hand = churn.model_matrix(scored_of(spark, sf_dir)).agg(F.avg(churn.logistic_score(_model(spark, sf_dir, "logistic")))).scalar()
    mean = F.col("avg_churn_probability")
    right = mean.between(0, 1) & (F.abs(mean - by_hand) < 1e-4)
    return money_as_double(measured.withColumn("avg_probability_checked", right).drop("avg_churn_probability"))


@_register("snk7_models_survive")
def _models_survive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all customers by the models as fitted and as saved and loaded."""
    models, path = churn.ChurnModels(*[_model(spark, sf_dir, w) for w in ("logistic", "forest")]), fresh_dir(spark, "models")
    models.save(path)
    loaded, scored = churn.ChurnModels.load(path), scored_of(spark, sf_dir)
    return validate.union_all([
        churn.disagreements(*[churn.probability(getattr(m, w), scored, "customer_id") for m in (models, loaded)], "customer_id").select(F.lit(w).alias("model"), "*")
        for w in ("logistic", "forest")])


@_register("snk7_model_round_trip")
def _model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the saved and re-loaded models, also written as JSON next to them."""
    models, test = churn.ChurnModels(*[_model(spark, sf_dir, w) for w in ("logistic", "forest")]), _cohorts(spark, sf_dir)[1]
    path = fresh_dir(spark, "models")
    models.save(path)
    loaded = churn.ChurnModels.load(path)
    parts = []
    for which in ("logistic", "forest"):
        scores = durable(
            churn.probability(getattr(loaded, which), test, "customer_id", churn.LABEL)
        )
        parts.append(churn.classification_metrics(scores).select(
            F.lit(which).alias("model"), "*"))
    metrics = validate.union_all(parts)
    writers.write_json(metrics, f"{path}/model_metrics.json")
    return spark.read.schema(metrics.schema).json(f"{path}/model_metrics.json")


# ---------------------------------------------------------------------- sources and sinks
@_register("src1_csv_round_trip")
def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders, some with line breaks, quotes, backslashes or empty text planted, written as CSV and read
    back with their schema; their sequence number travels as a text column."""
    path = f"{fresh_dir(spark, 'raw')}/orders.csv"
    odd = F.when(F.col("quantity") == 3, F.concat("order_status", F.lit('\n"x" \\n\\'))).when(
        F.col("quantity") == 4, F.lit("")).when(F.col("quantity") == 5, F.lit("\r\n,")).otherwise(F.col("order_status"))
    raw = etl_of(spark, sf_dir).raw.orders.withColumn("order_status", odd)
    writers.write_csv(raw.select(F.col("src_seq").cast("string").alias("row_seq"), *schemas.RAW_ORDERS.names), path)
    schema = T.StructType([T.StructField("row_seq", T.StringType()), *schemas.RAW_ORDERS.fields])
    back = readers.extract_raw_table(spark, path, "orders", schema, foreign=False)
    return back.drop("src_seq").withColumnRenamed("row_seq", "src_seq")


@_register("src2_extract_counts")
def _extract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_dir(spark, "raw")
    for name, df in etl_of(spark, sf_dir).raw.items().items():
        writers.write_csv(df.drop("src_seq"), f"{out}/{name}.csv")
    _, metadata = readers.extract_all(spark, out, RUN_TIMESTAMP, foreign=False)
    return metadata.select("extracted_at", "source_counts.*")


def _processed(spark: SparkSession, sf_dir: str) -> tuple[Etl, str]:
    etl = etl_of(spark, sf_dir)
    out = fresh_dir(spark, "processed")
    audit = run_audit(etl, "RUN_TEST")
    writers.save_processed_files(etl.valid, etl.rejected, audit, out)
    return etl, out


@_register("snk1_processed_files")
def _processed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorecard computed from the clean files that were written and read back."""
    _, out = _processed(spark, sf_dir)
    stored = readers.load_cleaned(spark, out)
    return money_as_double(reports.executive_scorecard(stored))


@_register("src6_dead_letter_file")
def _dead_letter_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead letters as their file gives them back, payloads included."""
    _, out = _processed(spark, sf_dir)
    return readers.read_dead_letters(spark, out)


@_register("snk2_audit_summary")
def _audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every number of the audit summary, from the JSON file that was written."""
    _, out = _processed(spark, sf_dir)
    return reports.audit_details(readers.read_audit_summary(spark, out))


def _table_prefix() -> str:
    return f"shelfmark_{uuid.uuid4().hex[:12]}_"


@_register("snk3_load_tables")
def _load_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    etl = etl_of(spark, sf_dir)
    tables = {**etl.valid.items(), "rejected_records": etl.rejected}
    return writers.load_tables(tables, _table_prefix(), fresh_dir(spark, "tables"))


@_register("snk9_list_tables")
def _list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    etl, prefix = etl_of(spark, sf_dir), _table_prefix()
    writers.load_tables(etl.valid.items(), prefix, fresh_dir(spark, "tables"))
    listed = writers.list_tables(spark, prefix)
    return listed.withColumn(
        "table_name", F.expr(f"substring(table_name, {len(prefix) + 1})")
    )


@_register("rpt21_audit_log")
def _audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appended runs, newest first, with the numbers of their audits."""
    name, path = f"{_table_prefix()}audit", fresh_dir(spark, "audit")
    etl = etl_of(spark, sf_dir)
    for run_id, stamp in (("RUN_A", "2001-08-01 00:00:00"), ("RUN_B", RUN_TIMESTAMP)):
        audit = run_audit(etl, run_id, stamp)
        writers.append_audit_row(audit_log_row(audit, "parquet"), name, path)
    log = readers.parsed_audit_log(reports.audit_history(spark.table(name)))
    return reports.audit_details(log, "audit.").drop("audit_json")


def _star_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = etl_of(spark, sf_dir).priced
    return {
        "dim_customer_analytics": _analytics(spark, sf_dir),
        "dim_date": _dates(t),
        "dim_products": star.dim_products(t.products),
        "dim_customers": star.dim_customers(t.customers),
        "fact_orders": facts.fact_orders(t.orders, t.products),
    }


@_register("snk6_star_export")
def _star_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded per star table after export to CSV and catalog tables."""
    tables = _star_tables(spark, sf_dir)
    return writers.export_star(
        tables, fresh_dir(spark, "star"), _table_prefix(), fresh_dir(spark, "tables"))


@_register("src5_star_import")
def _star_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five exported star tables, typed on import, against the catalog tables exported with
    them: rows of either side, and rows that the other side has not (repeats count)."""
    tables, out, prefix = _star_tables(spark, sf_dir), fresh_dir(spark, "star"), _table_prefix()
    writers.export_star(tables, out, prefix, fresh_dir(spark, "tables"))
    exported = {name: spark.table(f"{prefix}{name}") for name in tables}
    return star.import_differences(readers.read_star(spark, out), exported)


@_register("src4_sql_over_view")
def _sql_over_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK8 and SRC4: create the order view, then query it with SQL text."""
    t = etl_of(spark, sf_dir).priced
    view = writers.create_view(
        facts.order_analytics(t.orders, t.customers, t.products), "v_order_analytics"
    )
    return money_as_double(readers.execute_query(spark, f"""
        SELECT customer_state, product_category, COUNT(order_id) AS orders,
               SUM(net_revenue) AS net_revenue
        FROM {view} WHERE is_completed = 1
        GROUP BY customer_state, product_category"""))
