"""Every operator as a query over the TPC-H-like tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scratch import delete_folder, materialize, scratch_path, scratch_root
from ..functions.selection import exact_median
from ..functions.together import run_together
from ..operators import annotate, answers, churn, features, gold, mapping, metrics, quality, silver
from ..sources import adapters, csv, rates
from ..sources.adapters import Tables
from ..sources.tables import as_view, create_layers, describe_table, drop_table, layer, overwrite_table, read_table, sample_rows
from ..streaming.rates_feed import feed_rates
from . import builds

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every engine hands over alike: decimals as double, dates and timestamps without zone."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType)):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return portable(function(Tables(spark, folder)))

    QUERIES[function.__name__] = run
    return function


# --- silver tables as DataFrames, used by the queries below ---


def orders(t: Tables) -> DataFrame:
    return silver.clean_orders(adapters.raw_orders(t))


def customers(t: Tables) -> DataFrame:
    return silver.clean_customers(adapters.raw_customers(t))


def items(t: Tables) -> DataFrame:
    return silver.clean_order_items(adapters.raw_order_items(t))


def reviews(t: Tables) -> DataFrame:
    return silver.clean_reviews(adapters.raw_reviews(t))


def current_rates(t: Tables) -> DataFrame:
    return silver.latest_rates(adapters.raw_exchange_rates(t))


def payments(t: Tables) -> DataFrame:
    return adapters.raw_payments(t)


def star_sources(t: Tables, cleaned: DataFrame | None = None) -> tuple[DataFrame, ...]:
    """The staged inputs of the fact table; ``cleaned`` are the silver orders where a query has them already."""
    annotated = annotate.with_annotation_columns(reviews(t))
    return (
        gold.stg_orders(orders(t) if cleaned is None else cleaned),
        gold.stg_order_items(items(t)),
        gold.stg_reviews(annotated),
        gold.stg_exchange_rates(current_rates(t)),
    )


_SILVER = {"orders": orders, "customers": customers, "order_items": items, "reviews": reviews, "exchange_rates": current_rates}


def stored(t: Tables, name: str) -> DataFrame:
    """A silver table written first, for queries that read it more than once."""
    return materialize(_SILVER[name](t), name)


def rule_scores(t: Tables, cleaned: DataFrame | None = None) -> DataFrame:
    """A score table from a plain rule (the late rate as probability), so that SQL can compute it too."""
    table = stored(t, "orders") if cleaned is None else cleaned
    labels = features.churn_labels(table).select("customer_key", "churned")
    late = F.col("late_delivery_rate")
    return (
        features.order_features(table)
        .join(labels, "customer_key")
        .select("customer_key", "churned", late.alias("churn_probability"), (late > 0.3).cast("int").alias("predicted_churn"))
    )


# --- sources and sinks ---


@query
def csv_scan(t: Tables) -> DataFrame:
    """Order lines written as CSV text and read back by header, typed and NA-normalised."""
    path = scratch_path(t.spark, "csv")
    adapters.raw_order_items(t).write.csv(path, header=True, quote='"', escape='"')
    return csv.read_csv(t.spark, path, csv.CSV_FILES["raw_order_items"].types, line_breaks=False)


@query
def csv_scan_text(t: Tables) -> DataFrame:
    """Reviews with quotes and line breaks in their text through CSV and back."""
    path = scratch_path(t.spark, "csv")
    adapters.raw_reviews(t).write.csv(path, header=True, quote='"', escape='"', quoteAll=True)
    back = csv.read_csv(t.spark, path, csv.CSV_FILES["raw_reviews"].types, line_breaks=True)
    return back.select("review_id", "order_id", "review_score", F.md5("review_comment_message").alias("text_md5"))


@query
def rate_snapshots(t: Tables) -> DataFrame:
    """Rate payloads flattened to one row per currency."""
    return rates.flatten_rates(adapters.rate_payloads(t), F.col("fetched_at"))


@query
def rate_history_check(t: Tables) -> DataFrame:
    return rates.verify_rates(rate_snapshots(t))


def open_layers(t: Tables) -> None:
    """The layer databases, in the shared scratch folder unless the application has them already."""
    create_layers(t.spark, f"{scratch_root(t.spark)}/layers-{t.spark.sparkContext.applicationId}-{uuid.uuid4().hex}")


def new_table(t: Tables, layer_name: str, label: str) -> str:
    """The name of a table nobody has written yet."""
    open_layers(t)
    return layer(layer_name, f"{label}_{uuid.uuid4().hex}")


@query
def rate_history_appended(t: Tables) -> DataFrame:
    """Two appended snapshots read back from the partitioned history table."""
    table = new_table(t, "bronze", "rate_history")
    for _ in range(2):
        rates.append_rates(rates.flatten_rates(adapters.rate_payloads(t), F.col("fetched_at")), table)
    history = read_table(t.spark, table)
    return history.groupBy("fetch_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("target_currency").alias("currencies"))


@query
def rate_feed(t: Tables) -> DataFrame:
    """Payloads landed as files and taken up by the stream, in two calls of which the second finds nothing new."""
    landing, history, checkpoint = (scratch_path(t.spark, name) for name in ("landing", "history", "progress"))
    adapters.rate_payloads(t).select("payload").write.text(landing)
    for _ in range(2):
        feed_rates(t.spark, landing, history, checkpoint, one_per_line=True).awaitTermination()
    fed = t.spark.read.parquet(history)
    return fed.groupBy("base_currency", "target_currency").agg(
        F.count(F.lit(1)).alias("n"), F.min("exchange_rate").alias("lowest"), F.max("exchange_rate").alias("highest"),
        F.max("rate_timestamp").alias("newest"),
    )


@query
def rate_sample(t: Tables) -> DataFrame:
    return rates.sample_currencies(adapters.raw_exchange_rates(t).withColumn("target_currency", F.upper("target_currency")))


def broken_payloads(t: Tables) -> DataFrame:
    """Payloads of every kind that cannot be read whole, built in SQL from the events."""
    kind = F.col("event_id") % 7
    number = F.col("event_id").cast("string")
    good = F.concat(F.lit('{"timestamp": 1711843200, "base": "USD", "rates": {"BRL": '), number, F.lit("}}"))
    return t["events"].select(
        F.when(kind == 0, good)
        .when(kind == 1, F.concat(F.lit('{"timestamp": '), number))
        .when(kind == 2, F.lit('{"timestamp": 1, "base": "USD"}'))
        .when(kind == 3, F.lit('{"timestamp": 1, "base": "USD", "rates": {"BRL": "much", "EUR": 0.5}}'))
        .when(kind == 4, F.lit('{"base": "USD", "rates": {"BRL": 1}}'))
        .when(kind == 5, F.lit('{"timestamp": 1, "base": "USD", "rates": {"BRL": null, "JPY": 150}}'))
        .alias("payload")
    )


@query
def rate_rejects(t: Tables) -> DataFrame:
    """What could not be read of the payloads, by reason."""
    return rates.rate_rejects(broken_payloads(t)).groupBy("target_currency", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def rates_read_in_spite(t: Tables) -> DataFrame:
    """What is read of the same payloads when errors become NULL."""
    read = rates.flatten_rates(broken_payloads(t), F.lit(None).cast("timestamp"), on_error="null")
    return read.groupBy("target_currency").agg(F.count(F.lit(1)).alias("n"), F.sum("exchange_rate").alias("total"))


def uneven_lines(t: Tables) -> str:
    """Order lines as CSV text; every seventh line has a field too many, every fifth is short of its last."""
    path = scratch_path(t.spark, "csv")
    line = F.concat_ws(",", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    comment = F.when(F.col("l_orderkey") % 7 == 0, F.lit(",a,b")).when(F.col("l_orderkey") % 5 == 0, F.lit("")).otherwise(F.lit(",a"))
    # a separator and no quote, so that a line is written as it is, after the header in every file
    lines = t["lineitem"].select(F.concat(line, comment).alias("order,number,comment"))
    lines.write.csv(path, header=True, sep="\x01", quote="")
    return path


@query
def csv_rejects(t: Tables) -> DataFrame:
    """Lines with more fields than the header, handed out instead of cut."""
    refused = csv.csv_rejects(t.spark, uneven_lines(t), line_breaks=False)
    return refused.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query
def csv_read_in_spite(t: Tables) -> DataFrame:
    """The other lines of the same file; a short line lacks its last field."""
    rows = csv.read_csv(t.spark, uneven_lines(t), {"order": "bigint", "number": "int"}, line_breaks=False, on_error="null")
    return rows.groupBy("comment").agg(F.count(F.lit(1)).alias("n"), F.sum("order").alias("orders"))


@query
def table_profile(t: Tables) -> DataFrame:
    return describe_table(t["orders"]).unionByName(describe_table(t["lineitem"])).select("position", "column", "row_count", "null_count")


# --- bronze to silver ---


@query
def dedup_lines(t: Tables) -> DataFrame:
    """First line of every order: deduplication on a key with many copies."""
    return silver.dedup(adapters.raw_order_items(t), "order_id", ["order_item_id"])


@query
def cleaning_losses(t: Tables) -> DataFrame:
    lines = adapters.raw_order_items(t).withColumn("seller_id", F.when(F.col("seller_id") != "3", F.col("seller_id")))
    return silver.cleaning_losses(lines, "order_id", ["order_id", "seller_id"])


@query
def silver_orders(t: Tables) -> DataFrame:
    return orders(t)


@query
def silver_customers(t: Tables) -> DataFrame:
    return customers(t)


@query
def silver_order_items(t: Tables) -> DataFrame:
    return items(t)


@query
def silver_reviews(t: Tables) -> DataFrame:
    return reviews(t)


@query
def silver_exchange_rates(t: Tables) -> DataFrame:
    return current_rates(t)


@query
def silver_rejects(t: Tables) -> DataFrame:
    """Text parsed with ``on_error="null"``: part names are no timestamps, order lines are."""
    texts = t["part"].select(F.col("p_name").alias("x")).unionByName(
        adapters.raw_order_items(t).select(F.col("shipping_limit_date").alias("x"))
    )
    parsed = texts.select(silver.parse_timestamp("x", "null").alias("ts"))
    return parsed.agg(F.count(F.lit(1)).alias("n"), F.count("ts").alias("parsed"), F.max("ts").alias("newest"))


# --- mapping ---


@query
def mapped_orders(t: Tables) -> DataFrame:
    return mapping.apply_mapping(adapters.raw_orders(t), "orders")


@query
def mapping_conformance(t: Tables) -> DataFrame:
    frames = [mapping.conformance(f(t), name) for name, f in _SILVER.items()]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.select("table", "target_col", "null_count", "problem")


# --- quality ---


@query
def quality_orders(t: Tables) -> DataFrame:
    return quality.run_checks(stored(t, "orders"), "orders", quality.orders_suite(quality.EXPECTED_ORDERS))


@query
def quality_order_items(t: Tables) -> DataFrame:
    return quality.run_checks(items(t), "order_items", quality.order_items_suite())


@query
def quality_reviews(t: Tables) -> DataFrame:
    return quality.run_checks(stored(t, "reviews"), "reviews", quality.reviews_suite())


@query
def quality_failures(t: Tables) -> DataFrame:
    """Checks that fail on the order lines, with their samples and counts."""
    checks = [
        quality.unique("order_id"),
        quality.values_in("seller_id", ("1", "2", "3")),
        quality.values_between("freight_cost_brl", 5, 20, mostly=0.5),
        quality.row_count(1, 10),
        quality.no_nulls("no_such_column"),
    ]
    return quality.run_checks(stored(t, "order_items"), "order_items", checks)


@query
def quality_summary(t: Tables) -> DataFrame:
    return quality.summarize(quality.validate(stored(t, "orders"), items(t), stored(t, "reviews"), quality.EXPECTED_ORDERS))


@query
def quality_overall(t: Tables) -> DataFrame:
    return quality.overall(quality.validate(stored(t, "orders"), items(t), stored(t, "reviews"), quality.EXPECTED_ORDERS))


@query
def quality_gold(t: Tables) -> DataFrame:
    """The star-schema tests over the four gold tables, made from one copy of the silver orders."""
    cleaned = stored(t, "orders")
    fact = materialize(gold.fact_orders(*star_sources(t, cleaned)), "fact")
    scores = gold.stg_churn_scores(churn.score(rule_scores(t, cleaned)))
    tables = {
        "dim_customer": gold.dim_customer(gold.stg_customers(customers(t)), scores),
        "dim_product": dim_product(t),
        "dim_date": gold.dim_date(gold.span_of(cleaned, "order_date")),
        "fact_orders": fact,
    }
    results = None
    for name, df in tables.items():
        one = quality.run_checks(df, name, quality.GOLD_SUITES[name])
        results = one if results is None else results.unionByName(one)
    return results


# --- features ---


@query
def churn_labels(t: Tables) -> DataFrame:
    return features.churn_labels(orders(t))


@query
def order_features(t: Tables) -> DataFrame:
    return features.order_features(orders(t))


@query
def spend_features(t: Tables) -> DataFrame:
    return features.spend_features(orders(t), items(t))


@query
def review_features(t: Tables) -> DataFrame:
    return features.review_features(orders(t), reviews(t))


@query
def primary_payment(t: Tables) -> DataFrame:
    return features.primary_payment(orders(t), payments(t))


@query
def customer_location(t: Tables) -> DataFrame:
    return features.customer_location(customers(t))


@query
def category_codes(t: Tables) -> DataFrame:
    return features.category_codes(t["part"], "p_brand", "code")


@query
def long_category_codes(t: Tables) -> DataFrame:
    """Codes of a column with as many values as rows, ranked in ranges rather than in one task."""
    return features.category_codes(t["customer"], "c_name", "code")


@query
def delivery_median(t: Tables) -> DataFrame:
    return exact_median(features.order_features(orders(t)), "avg_days_to_deliver", "median_days")


@query
def feature_store(t: Tables) -> DataFrame:
    return features.build_features(orders(t), customers(t), items(t), reviews(t), payments(t))


# --- churn model ---


@query
def training_split(t: Tables) -> DataFrame:
    return churn.split(features.churn_labels(orders(t)).select("customer_key", "churned"))


@query
def class_weights(t: Tables) -> DataFrame:
    return churn.class_weights(features.churn_labels(orders(t)))


@query
def risk_tiers(t: Tables) -> DataFrame:
    return churn.score(rule_scores(t))


@query
def risk_distribution(t: Tables) -> DataFrame:
    return churn.risk_distribution(churn.score(rule_scores(t)))


@query
def class_report(t: Tables) -> DataFrame:
    return churn.class_report(rule_scores(t))


@query
def model_accuracy(t: Tables) -> DataFrame:
    return churn.accuracy(rule_scores(t))


@query
def model_auc(t: Tables) -> DataFrame:
    scored = materialize(rule_scores(t), "scored")
    return scored.agg(F.count(F.lit(1)).alias("n")).withColumn("auc_roc", F.round(F.lit(churn.auc_roc(scored)), 9))


_fitted: dict[tuple[str, str], tuple] = {}


def fitted(t: Tables) -> tuple:
    """The split feature table and the forest trained on it, once per application and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _fitted:
        table = materialize(churn.split(materialize(feature_store(t), "feature_store")), "split")
        _fitted[key] = table, churn.train(table.where(~F.col("is_test")))
    return _fitted[key]


@query
def churn_scores(t: Tables) -> DataFrame:
    """Every customer scored by the forest. A forest has no SQL form, so each row says whether its parts agree: the score is
    a probability, the tier and the class are those of the score (either of the two at a rounded limit)."""
    table, model = fitted(t)
    scores = churn.score(churn.predict(model, table))
    p = F.col("churn_score")
    low, high = churn.risk_tier(p - 0.00005), churn.risk_tier(p + 0.00005)
    tier = F.col("churn_risk")
    return scores.select(
        "customer_key",
        "actual_churned",
        p.between(0, 1).alias("is_probability"),
        (tier.eqNullSafe(low) | tier.eqNullSafe(high)).alias("tier_agrees"),
        ((F.col("predicted_churn") == (p > 0.5).cast("int")) | (p == 0.5)).alias("class_agrees"),
    )


@query
def churn_evaluation(t: Tables) -> DataFrame:
    """Sizes of the two shares, and whether accuracy and AUC on the held-out one are what the label allows."""
    table, model = fitted(t)
    measured = churn.evaluate(model, table.where("is_test"))
    return table.agg(F.count(F.lit(1)).alias("customers"), F.count_if("is_test").alias("held_out")).select(
        "customers", "held_out", *[F.lit(v > 0.9).alias(f"high_{k}") for k, v in measured.items()]
    )


@query
def feature_importance(t: Tables) -> DataFrame:
    """The label follows from the recency, so that must come first; importances are shares of 1."""
    ranked = churn.feature_importance(fitted(t)[1], t.spark)
    return ranked.agg(
        F.max_by("feature", "importance").alias("first_feature"),
        F.count(F.lit(1)).alias("inputs"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


# --- star schema ---


@query
def stg_orders(t: Tables) -> DataFrame:
    return gold.stg_orders(orders(t))


@query
def stg_customers(t: Tables) -> DataFrame:
    return gold.stg_customers(customers(t))


@query
def stg_order_items(t: Tables) -> DataFrame:
    return gold.stg_order_items(items(t))


@query
def stg_reviews(t: Tables) -> DataFrame:
    return gold.stg_reviews(annotate.annotated_reviews(reviews(t), annotations(t)))


@query
def stg_products(t: Tables) -> DataFrame:
    return gold.stg_products(adapters.raw_products(t))


@query
def stg_exchange_rates(t: Tables) -> DataFrame:
    return gold.stg_exchange_rates(current_rates(t))


@query
def stg_churn_scores(t: Tables) -> DataFrame:
    return gold.stg_churn_scores(churn.score(rule_scores(t)))


@query
def dim_customer(t: Tables) -> DataFrame:
    return gold.dim_customer(gold.stg_customers(customers(t)), gold.stg_churn_scores(churn.score(rule_scores(t))))


@query
def dim_product(t: Tables) -> DataFrame:
    return gold.dim_product(gold.stg_products(adapters.raw_products(t)))


@query
def dim_date_fixed(t: Tables) -> DataFrame:
    """The fixed calendar of four years."""
    return gold.dim_date(gold.calendar_span(t.spark))


@query
def dim_date_built(t: Tables) -> DataFrame:
    """The calendar the gold build writes: the fixed one and all days of the orders."""
    return gold.dim_date(gold.fixed_and(gold.span_of(orders(t), "order_date")))


@query
def dim_date(t: Tables) -> DataFrame:
    """The calendar of the days the orders cover."""
    return gold.dim_date(gold.span_of(orders(t), "order_date"))


@query
def fact_orders(t: Tables) -> DataFrame:
    return gold.fact_orders(*star_sources(t))


@query
def fact_orders_one_review(t: Tables) -> DataFrame:
    """At most one review per order, annotated."""
    stg_orders, stg_items, _, stg_rates = star_sources(t)
    return gold.fact_orders(stg_orders, stg_items, stg_reviews(t), stg_rates, single_review=True)


@query
def fact_lines_salted(t: Tables) -> DataFrame:
    """The fact rows with every order of more than two lines or reviews cut into pieces."""
    return gold.order_lines(*star_sources(t), hot_options={"rows_per_task": 2}).groupBy("status_code").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount_brl").alias("brl"), F.sum("review_rating").alias("stars")
    )


# --- annotation ---


def keyword_annotator() -> annotate.Annotator:
    """A stand-in annotator: everything follows from the stars. Built here so that it travels to the workers whole."""
    import json
    import re

    def judge(review: str, stars: int) -> dict:
        return {
            "review_id": review,
            "sentiment": "positive" if stars >= 4 else "negative" if stars <= 2 else "neutral",
            "confidence": stars / 10,
            "primary_topic": "delivery" if stars % 2 else "other",
            "needs_human_review": stars == 3,
        }

    def answer(prompts):
        found = [re.findall(r"^  review_id: (.*)\n  rating: (\d+)$", prompt, flags=re.M) for prompt in prompts]
        return [json.dumps({"annotations": [judge(review, int(stars)) for review, stars in one]}) for one in found]

    return answer


def responses(t: Tables) -> DataFrame:
    queue = annotate.annotation_queue(reviews(t), limit=None)
    prompts = annotate.build_prompts(annotate.make_batches(queue))
    return materialize(annotate.apply_annotator(prompts, keyword_annotator()), "responses")


def annotations(t: Tables) -> DataFrame:
    return annotate.last_per_review(annotate.parse_annotations(responses(t)))


def payload_responses(t: Tables) -> DataFrame:
    """Answers of every shape built in SQL from the events: wrapped lists, bare lists, no list, broken text."""
    shape = F.col("event_id") % 5
    item = F.format_string(
        '{"review_id": "%d", "sentiment": "%s", "confidence": %.2f, "primary_topic": "other"}',
        F.expr("event_id div 2"), F.when(F.col("value") > 20, "positive").otherwise("negative"), F.col("event_id") % 100 / 100,
    )
    return t["events"].select(
        F.col("event_id").alias("batch_id"),
        F.lit(1).alias("batch_size"),
        F.when(shape == 0, F.concat(F.lit("["), item, F.lit("]")))
        .when(shape == 1, F.concat(F.lit('{"n": 1, "found": ['), item, F.lit("]}")))
        .when(shape == 2, F.lit('{"found": 0}'))
        .when(shape == 3, F.concat(F.lit("[{"), item))
        .otherwise(F.lit("[]"))
        .alias("response"),
        F.lit(None).cast("string").alias("error"),
    )


@query
def annotation_queue(t: Tables) -> DataFrame:
    """The work queue: at most 500 reviews, the lowest ids first."""
    return annotate.annotation_queue(reviews(t)).select("review_id", "order_id", "rating", F.length("review_text").alias("chars"))


@query
def annotation_prompts(t: Tables) -> DataFrame:
    """Every waiting review in batches of ten, with the request text of each batch."""
    batches = annotate.make_batches(annotate.annotation_queue(reviews(t), limit=None))
    return annotate.build_prompts(batches).select("batch_id", "batch_size", F.md5("prompt").alias("prompt_md5"))


@query
def annotation_results(t: Tables) -> DataFrame:
    """Queue, prompts, annotator and parser over all reviews with text."""
    return annotations(t)


def moody_annotator(refused: str) -> annotate.Annotator:
    """Answers with an empty list, but fails for prompts whose MD5 begins with a digit below ``refused``."""

    def answer(prompts):
        import hashlib

        marks = [hashlib.md5(prompt.encode()).hexdigest() for prompt in prompts]
        return [RuntimeError("refused") if mark < refused else "[]" for mark in marks]

    return answer


def asked_twice(t: Tables) -> tuple[DataFrame, DataFrame]:
    """All prompts, and the store after a run in which half of them failed and one that asked again for those alone."""
    prompts = materialize(annotate.build_prompts(annotate.make_batches(annotate.annotation_queue(reviews(t), limit=None))), "prompts")
    store = scratch_path(t.spark, "answers")
    for refused in ("8", "4"):
        answers.ask(prompts, moody_annotator(refused), store, most_attempts=2, prompts_per_call=100, written=True)
    return prompts, answers.read_answers(t.spark, store)


@query
def annotation_resumed(t: Tables) -> DataFrame:
    """What each prompt was asked and answered in two runs over one store."""
    prompts, stored = asked_twice(t)
    state = answers.answer_state(stored).select("request", "attempts", F.col("response").isNotNull().alias("answered"))
    return answers.with_requests(prompts).join(state, "request").select("batch_id", "batch_size", "attempts", "answered")


@query
def annotation_dead_letters(t: Tables) -> DataFrame:
    """The prompts given up after both runs."""
    return answers.dead_letters(*asked_twice(t), most_attempts=2)


@query
def parsed_responses(t: Tables) -> DataFrame:
    return annotate.parse_annotations(payload_responses(t)).drop("place", "item_error")


@query
def response_problems(t: Tables) -> DataFrame:
    return annotate.read_responses(payload_responses(t)).groupBy("error", "warning").agg(F.count(F.lit(1)).alias("n"))


@query
def response_trailing_text(t: Tables) -> DataFrame:
    """Answers with text after their JSON value, or with a key twice: none of them counts as one."""
    kind = F.col("event_id") % 5
    text = (
        F.when(kind == 0, '[{"review_id": "1"}] oops ]')
        .when(kind == 1, '{"a": [{"review_id": "1"}]} and {"b": 2}')
        .when(kind == 2, '[{"review_id": "1"}], [{"review_id": "2"}]')
        .when(kind == 3, '{"a": [{"review_id": "1"}], "a": [{"review_id": "2"}]}')
        .otherwise('\n [{"review_id": "1"}]\t')
    )
    answers = t["events"].select(F.col("event_id").alias("batch_id"), F.lit(1).alias("batch_size"), text.alias("response"), F.lit(None).cast("string").alias("error"))
    read = annotate.read_responses(answers)
    return read.groupBy("error").agg(F.count(F.lit(1)).alias("n"), F.sum(F.coalesce(F.size("items"), F.lit(0))).alias("items"))


@query
def annotation_upsert(t: Tables) -> DataFrame:
    """Annotations from the events replace those the annotator gave; the last one of a review wins."""
    new = annotate.last_per_review(annotate.parse_annotations(payload_responses(t)))
    return annotate.upsert_annotations(annotations(t), new)


@query
def annotation_state(t: Tables) -> DataFrame:
    """The same from the log: the first run is folded into the state, the second one is still to be."""
    table = new_table(t, "silver", "annotations")
    annotate.append_annotations(annotations(t), table)
    annotate.compact_annotations(t.spark, table, after=1)
    annotate.append_annotations(annotate.last_per_review(annotate.parse_annotations(payload_responses(t))), table)
    return annotate.read_annotations(t.spark, table)


@query
def annotation_summary(t: Tables) -> DataFrame:
    answers = payload_responses(t)
    return annotate.run_summary(answers, annotate.parse_annotations(answers), annotate.annotation_queue(reviews(t), limit=None))


@query
def annotation_checks(t: Tables) -> DataFrame:
    return annotate.check_annotations(annotate.last_per_review(annotate.parse_annotations(payload_responses(t))))


@query
def top_annotations(t: Tables) -> DataFrame:
    annotated = annotate.annotated_reviews(reviews(t), annotations(t))
    return annotate.top_annotations(annotated)


# --- run metrics ---


@query
def recent_runs(t: Tables) -> DataFrame:
    return metrics.recent_runs(adapters.stage_log(t))


@query
def run_summary(t: Tables) -> DataFrame:
    return metrics.run_summary(adapters.stage_log(t))


@query
def latest_runs(t: Tables) -> DataFrame:
    return metrics.latest_runs(adapters.stage_log(t))


@query
def layer_health(t: Tables) -> DataFrame:
    spark = t.spark
    return (
        metrics.table_health(adapters.raw_orders(t), "bronze.raw_orders", spark)
        .unionByName(metrics.table_health(orders(t), "silver.orders", spark, "order_date"))
        .unionByName(metrics.table_health(items(t).where("item_price_brl < 0"), "silver.empty", spark))
        .unionByName(metrics.table_health(None, "gold.none", spark))
    )


@query
def run_model_summary(t: Tables) -> DataFrame:
    """Model figures read back from the metrics rows of one run."""
    log = adapters.stage_log(t).withColumn(
        "extra_metrics",
        F.to_json(F.struct((F.col("rows_processed") % 100 / 100).alias("auc_roc"), F.lit(0.5).alias("accuracy"))),
    )
    return metrics.model_summary(log, "7", "view")


# --- layers, builds and runs: written to catalog tables and read back ---


def write_csv_files(t: Tables, lower_prices: bool = False) -> str:
    """All bronze shapes as CSV files under the names the loader looks for."""
    folder = scratch_path(t.spark, "csv-files")

    def write(table: str, file: csv.CsvFile) -> None:
        df = adapters.BRONZE[table](t)
        if lower_prices and table == "raw_order_items":  # into the range the quality gate allows
            df = df.withColumn("price", F.round(F.col("price") / 20, 2))
        df.write.csv(f"{folder}/{file.name}", header=True, quote='"', escape='"', quoteAll=file.line_breaks)

    run_together(t.spark, [partial(write, table, file) for table, file in csv.CSV_FILES.items()])
    return folder


@query
def table_refreshed(t: Tables) -> DataFrame:
    """A table refreshed from itself by its lines of two and more pieces, after which a refresh that fails half-way changes nothing."""
    table = new_table(t, "silver", "lines")
    overwrite_table(t["lineitem"].select("l_orderkey", "l_returnflag", "l_quantity"), table)
    overwrite_table(t.spark.table(table).where("l_quantity >= 2"), table)
    broken = F.when(F.col("l_orderkey") % 2 == 0, F.col("l_quantity")).otherwise(F.raise_error(F.lit("stopped on purpose")))
    try:
        overwrite_table(t.spark.table(table).withColumn("l_quantity", broken.cast("double")), table)
    except Exception as error:
        if "stopped on purpose" not in str(error):
            raise
    return t.spark.table(table).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("pieces"))


@query
def csv_tables_loaded(t: Tables) -> DataFrame:
    """Every CSV file that exists loaded twice into its bronze table; the second load replaces the first."""
    open_layers(t)
    folder = write_csv_files(t)
    missing = {"raw_nothing": csv.CsvFile("no_such_file.csv")}
    for _ in range(2):
        rows = csv.load_all_csv(t.spark, folder, {**csv.CSV_FILES, **missing})
    counted = [(name, n, None if n is None else read_table(t.spark, layer("bronze", name)).count()) for name, n in rows.items()]
    return t.spark.createDataFrame(counted, "table string, loaded bigint, stored bigint")


@query
def silver_build_status(t: Tables) -> DataFrame:
    """Rows written, read and lost per silver table, from the build itself. A fifth of the reviews has no order."""
    open_layers(t)
    bronze = {name: make(t) for name, make in adapters.BRONZE.items()}
    orphan = F.col("review_id").cast("long") % 5 == 0
    bronze["raw_reviews"] = bronze["raw_reviews"].withColumn("order_id", F.when(~orphan, F.col("order_id")))
    bronze["raw_customers"] = bronze["raw_customers"].unionByName(bronze["raw_customers"])
    return builds.build_silver(t.spark, bronze).drop("error")


@query
def quality_gate(t: Tables) -> DataFrame:
    """Whether the gate stops a run over these tables, and with which counts."""
    results = quality.validate(stored(t, "orders"), items(t), stored(t, "reviews"), quality.EXPECTED_ORDERS)
    try:
        passed, stopped = quality.require_quality(results), False
    except quality.QualityError as error:
        passed, stopped = {"checks_passed": error.passed, "checks_total": error.total}, True
    row = (passed["checks_passed"], passed["checks_total"], stopped)
    return t.spark.createDataFrame([row], "checks_passed bigint, checks_total bigint, stopped boolean")


@query
def layer_tables(t: Tables) -> DataFrame:
    """Feature and score tables written to the ml layer, read back whole, by a view and by a few sample rows."""
    open_layers(t)
    store, scores = new_table(t, "ml", "feature_store"), new_table(t, "ml", "churn_scores")
    cleaned = stored(t, "orders")
    overwrite_table(features.build_features(cleaned, customers(t), items(t), reviews(t), payments(t)), store)
    for _ in range(2):
        overwrite_table(churn.score(rule_scores(t, cleaned)), scores)
    as_view(read_table(t.spark, scores).where("churn_risk IS NOT NULL"), "tiered_scores")
    parts = [
        read_table(t.spark, store).agg(F.lit("feature_store").alias("name"), F.count(F.lit(1)).alias("n"), F.sum("total_orders").alias("total")),
        read_table(t.spark, scores).agg(F.lit("churn_scores").alias("name"), F.count(F.lit(1)).alias("n"), F.sum("actual_churned").alias("total")),
        t.spark.table("tiered_scores").agg(F.lit("tiered_scores").alias("name"), F.count(F.lit(1)).alias("n"), F.sum("predicted_churn").alias("total")),
        sample_rows(read_table(t.spark, scores)).agg(F.lit("sample").alias("name"), F.count(F.lit(1)).alias("n"), F.lit(0).cast("long").alias("total")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def model_saved_and_loaded(t: Tables) -> DataFrame:
    """Customers the loaded model scores exactly as the saved one did."""
    table, model = fitted(t)
    path = scratch_path(t.spark, "model")
    churn.save_model(model, path)
    columns = ["customer_key", "churn_probability", "predicted_churn"]
    before = churn.predict(model, table).select(*columns)
    after = churn.predict(churn.load_model(path), table).select(*columns)
    return before.join(after, columns).agg(F.count(F.lit(1)).alias("customers"))


@query
def annotations_waiting(t: Tables) -> DataFrame:
    """The queue that is left when every other review has an annotation."""
    known = annotations(t).where(F.col("review_id").cast("long") % 2 == 0)
    return annotate.annotation_queue(reviews(t), known, limit=None).select("review_id", "rating")


@query
def metrics_recorded(t: Tables) -> DataFrame:
    """A stage that ends well, one that fails, and a single record, read back from the metrics table."""
    open_layers(t)
    metrics.setup_metrics_table(t.spark)
    run = uuid.uuid4().hex
    with metrics.Stage(t.spark, run, "count_orders") as stage:
        stage.rows = t["orders"].count()
    try:
        with metrics.Stage(t.spark, run, "count_parts") as stage:
            stage.rows = t["part"].count()
            raise ValueError("stopped on purpose")
    except ValueError:
        pass
    metrics.record_metric(t.spark, run, "note", "success", t["nation"].count(), 1.5, {"k": 1})
    log = t.spark.table(metrics.METRICS_TABLE).where(F.col("run_id") == run)
    seconds = F.col("duration_seconds") >= 0
    return log.select("stage", "status", "rows_processed", seconds.alias("timed"), F.col("error_message").contains("on purpose").alias("told"))


@query
def whole_run(t: Tables) -> DataFrame:
    """The monitored run from CSV files and a payload to gold, with its rows per stage."""
    open_layers(t)
    for table in ("bronze.raw_exchange_rates", builds.ANNOTATIONS_TABLE, annotate.state_table(builds.ANNOTATIONS_TABLE)):
        drop_table(t.spark, table)
    run = uuid.uuid4().hex
    landing, model = scratch_path(t.spark, "landing"), scratch_path(t.spark, "model")
    number = t["orders"].agg(F.count(F.lit(1)).cast("string").alias("n"))
    payload = F.concat(F.lit('{"timestamp": 1711843200, "base": "USD", "rates": {"BRL": 5.0, "XTS": '), "n", F.lit("}}"))
    number.select(payload).coalesce(1).write.text(landing)
    files = write_csv_files(t, lower_prices=True)
    builds.run_everything(t.spark, run, files, landing, model, csv_loaded=lambda: delete_folder(t.spark, files))
    log = t.spark.table(metrics.METRICS_TABLE).where(F.col("run_id") == run)
    return log.select("stage", "status", "rows_processed")
