"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks.bindings import (
    AS_OF,
    MIDDLE,
    events_log,
    events_ratings,
    exclusion_rules,
    orders_items,
    orders_log,
    orders_ratings,
    part_items,
    split_ratings,
    table,
    timed_ratings,
    vectors,
)
from shelfwise import schema
from shelfwise.functions.affinity import clamp, flag_positive
from shelfwise.functions.clock import day_ago, epoch_bounds
from shelfwise.functions.messages import judge_event, parse_event, render_recs_json
from shelfwise.functions.splits import TEST, bucket_of, split_of
from shelfwise.operators import dims, evaluation, exclusions, interactions, merge, model, selection, topk
from shelfwise.operators.sizing import written
from shelfwise.plans.imports import job_import, job_import_raw, rejected_lines
from shelfwise.plans.recommend import (
    job_incremental,
    job_offline,
    job_stream,
    job_train,
    recs_publish,
    stamped,
)
from shelfwise.plans.warehouse import file_warehouse, recommendable_ratings, stored_ratings
from shelfwise.session import scratch_path
from shelfwise.sources.csv_log import csv_log_rejects, csv_log_scan
from shelfwise.sources.tables import Table, table_append, table_overwrite, table_scan
from shelfwise.streaming import channels, history, retrain

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TOP_N = 10
RATING_COLUMNS = [*interactions.PAIR, *schema.COUNT_COLUMNS, "rating"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def query_named(name: str) -> Callable[[Query], Query]:
    """For a query whose name an imported operator already has."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources and sinks ---------------------------------------------------------


def csv_v1(spark, sf_dir) -> str:
    path = scratch_path(spark, "log-v1")
    orders_log(spark, sf_dir).select(*schema.LOG_V1.fieldNames()).write.option("header", True).csv(path)
    return path


def csv_v2(spark, sf_dir, condition) -> str:
    path = scratch_path(spark, "log-v2")
    events_log(spark, sf_dir).where(condition).select(
        F.col("user_id").alias("customer_id"),
        "item_id",
        F.lit(None).cast("int").alias("category_id"),
        F.lit(None).cast("int").alias("brand_id"),
        "action",
        F.col("created_at").alias("unix_created_at"),
    ).write.option("header", True).csv(path)
    return path


@query_named("csv_log_scan")
def csv_log_scan_v1(spark, sf_dir):
    return csv_log_scan(spark, csv_v1(spark, sf_dir), schema.LOG_V1)


@query
def csv_log_scan_v2(spark, sf_dir):
    log = csv_log_scan(spark, csv_v2(spark, sf_dir, F.lit(True)), schema.LOG_V2)
    return schema.canonical_log(log).select("user_id", "item_id", "action", "created_at")


def csv_with_faults(spark, sf_dir) -> str:
    """The narrow log as CSV, some values replaced by what isn't one."""
    path, k = scratch_path(spark, "log-faults"), F.col("event_id") % 50
    text = lambda c: F.col(c).cast("string")
    events_log(spark, sf_dir).select(
        F.when(k == 2, None).when(k == 5, str(1 << 40)).otherwise(text("user_id")).alias("customer_id"),
        F.when(k == 0, "abc").when(k == 4, None).otherwise(text("item_id")).alias("item_id"),
        F.lit(None).cast("string").alias("category_id"),
        F.lit(None).cast("string").alias("brand_id"),
        F.when(k == 1, "2.0").otherwise(text("action")).alias("action"),
        F.when(k == 6, "NaN").otherwise(text("created_at")).alias("unix_created_at"),
    ).write.option("header", True).csv(path)
    return path


@query_named("csv_log_rejects")
def csv_log_rejects_lines(spark, sf_dir):
    return csv_log_rejects(spark, csv_with_faults(spark, sf_dir), schema.LOG_V2)


@query
def job_import_raw_faults(spark, sf_dir):
    """Pairs of an import from a log with faults, and how many lines of each kind it rejected."""
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    done = job_import_raw(spark, csv_with_faults(spark, sf_dir), tables)
    rejected = [F.lit(done.rejected.get(reason, 0)).cast("long").alias("n_" + reason.replace(" ", "_")) for reason in ("malformed", "no user", "no item")]
    kept = rejected_lines(spark, tables).groupBy().agg(F.count("line").alias("n_kept"))
    return rounded(stored_ratings(spark, tables), "rating").select("user_id", "item_id", "rating", *rejected).join(F.broadcast(kept))


@query_named("table_scan")
def table_scan_pruned(spark, sf_dir):
    target = Table(scratch_path(spark, "log-table"))
    table_overwrite(orders_log(spark, sf_dir), target)
    return table_scan(spark, target, ["user_id", "item_id", "action"])


@query
def log_append_rebuild(spark, sf_dir):
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    job_import_raw(spark, csv_v2(spark, sf_dir, F.col("created_at") < MIDDLE), tables)
    job_import_raw(spark, csv_v2(spark, sf_dir, F.col("created_at") >= MIDDLE), tables)
    return rounded(stored_ratings(spark, tables), "rating")


@query_named("table_overwrite")
def table_overwrite_self(spark, sf_dir):
    """Replace a table by rows computed from itself."""
    target = Table(scratch_path(spark, "ratings"))
    table_overwrite(events_ratings(spark, sf_dir).select(*RATING_COLUMNS), target)
    table_overwrite(table_scan(spark, target).withColumn("rating", F.col("rating") / 5), target, reads_target=True)
    return rounded(table_scan(spark, target), "rating")


@query_named("table_append")
def table_append_twice(spark, sf_dir):
    target = Table(scratch_path(spark, "items"))
    items = orders_items(spark, sf_dir)
    table_append(items, target)
    table_append(items, target)
    return table_scan(spark, target)


@query_named("recs_publish")
def recs_publish_table(spark, sf_dir):
    every = vectors(spark, sf_dir)
    recs = stamped(topk.topk_items_per_user(every, every, TOP_N), AS_OF)
    target = recs_publish(recs, Table(scratch_path(spark, schema.RECOMMENDATION_TABLE)), "_v2")
    return rounded(table_scan(spark, target), "rating")


@query
def replace_by_key(spark, sf_dir):
    """Users active on the last day get only their last day's pairs, the others keep all."""
    columns = ["user_id", "item_id", "rating"]
    log = events_log(spark, sf_dir)
    old = interactions.build_ratings(log).select(*columns)
    last_day = log.where(F.col("created_at") >= day_ago(F.lit(AS_OF)))
    new = interactions.build_ratings(last_day).select(*columns)
    return rounded(merge.replace_by_key(old, new), "rating")


@query
def upsert_by_key(spark, sf_dir):
    """First-half ratings, upserted with the second half's events; an error sets null."""
    log = events_log(spark, sf_dir)
    stored = interactions.build_ratings(log.where(F.col("created_at") < MIDDLE))
    updates = log.where(F.col("created_at") >= MIDDLE).select(
        "user_id",
        "item_id",
        F.when(F.col("action").isNotNull(), F.col("value")).alias("rating"),
        F.col("created_at").alias("updated_at"),
    )
    merged = merge.upsert_by_key(
        stored.select("user_id", "item_id", "viewed_count", "rating", "updated_at"),
        updates,
        ["user_id", "item_id"],
        "updated_at",
    )
    return rounded(merged, "rating")


def message_text(spark, sf_dir) -> DataFrame:
    """Every event as a JSON message; an ``error`` event gives malformed text."""
    text = F.to_json(
        F.struct(
            F.col("user_id").cast("string").alias("customer_id"),
            F.col("item_id").cast("string").alias("item_id"),
            F.col("value").alias("rating"),
        )
    )
    return events_log(spark, sf_dir).select(
        F.when(F.col("action").isNotNull(), text).otherwise(F.concat(F.lit("{broken "), "user_id")).alias("value")
    )


def message_stream(spark, sf_dir, files: int = 2) -> DataFrame:
    path = scratch_path(spark, "messages")
    message_text(spark, sf_dir).repartition(files).write.text(path)
    return channels.stream_source(spark, "text", {"path": path, "maxFilesPerTrigger": "1"})


def drained(spark, messages: DataFrame, handle) -> None:
    stream = retrain.micro_batch(messages, handle, scratch_path(spark, "progress"), available_now=True)
    stream.awaitTermination()


@query
def stream_source(spark, sf_dir):
    path = scratch_path(spark, "received")
    drained(
        spark,
        message_stream(spark, sf_dir),
        lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"),
    )
    return parse_event(spark.read.parquet(path))


@query
def micro_batch(spark, sf_dir):
    path = scratch_path(spark, "batches")

    def count(batch, batch_id):
        counted = batch.groupBy().agg(F.count("value").alias("n_messages"))
        counted.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    drained(spark, message_stream(spark, sf_dir, files=3), count)
    return spark.read.parquet(path).agg(
        F.count("batch_id").alias("n_batches"), F.sum("n_messages").alias("n_messages")
    )


@query
def rating_stream_state(spark, sf_dir):
    path = scratch_path(spark, "history")

    def record(batch, batch_id):
        history.record_batch(parse_event(batch).where("is_valid"), batch_id, path)

    drained(spark, message_stream(spark, sf_dir), record)
    return rounded(history.rating_stream_state(spark, events_ratings(spark, sf_dir), path), "rating")


@query
def stream_rejects(spark, sf_dir):
    """Messages with faults of each kind, as the stream keeps them."""
    path, source, k = scratch_path(spark, "history"), scratch_path(spark, "messages"), F.col("event_id") % 20
    user = F.when(k == 0, "x").otherwise(F.col("user_id").cast("string"))
    item = F.when(k == 1, str(1 << 40)).otherwise(F.col("item_id").cast("string"))
    rating = F.when(k == 2, '"abc"').when(k == 3, "null").otherwise("3.5")
    text = F.concat(F.lit('{"customer_id":"'), user, F.lit('","item_id":"'), item, F.lit('","rating":'), rating, F.when(k == 4, "").otherwise("}"))
    events_log(spark, sf_dir).select(text.alias("value")).repartition(2).write.text(source)
    messages = channels.stream_source(spark, "text", {"path": source, "maxFilesPerTrigger": "1"})
    drained(spark, messages, lambda batch, batch_id: history.record_rejects(judge_event(batch), batch_id, path))
    return history.recorded_rejects(spark, path).select("value", "reason")


@query
def stream_sink(spark, sf_dir):
    every = vectors(spark, sf_dir)
    path = scratch_path(spark, "published")
    recs = rounded(topk.topk_items_per_user(every, every, TOP_N), "rating", digits=3)
    channels.stream_sink(recs, 0, "parquet", {"path": path})
    return spark.read.parquet(f"{path}/batch_id=0")


@query
def stream_retrain_recommend(spark, sf_dir):
    path = scratch_path(spark, "stream")
    base = wide_pairs(spark, sf_dir)
    handler = retrain.Retrainer(
        load_base=lambda: base,
        history_path=f"{path}/history",
        sink_format="parquet",
        sink_options={"path": f"{path}/published"},
    )
    drained(spark, message_stream(spark, sf_dir), handler)
    return message_facts(spark.read.parquet(f"{path}/published")).drop("n_messages")


def message_facts(published: DataFrame) -> DataFrame:
    """Per user: messages, items of a list, and whether each list is of that user alone and falls."""
    lists = published.select(F.from_json("value", "array<struct<user:long, product:long, rating:double>>").alias("l"))
    ratings = F.transform("l", lambda r: r["rating"])
    one = F.size(F.array_distinct(F.transform("l", lambda r: r["user"]))) == 1
    return (
        lists.select(
            F.col("l")[0]["user"].alias("user_id"),
            F.size(F.array_distinct(F.transform("l", lambda r: r["product"]))).cast("long").alias("n_items"),
            (one & (ratings == F.sort_array(ratings, asc=False))).alias("sound"),
        )
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n_messages"), F.max("n_items").alias("n_items"), F.bool_and("sound").alias("sound"))
    )


# --- projections, filters, predicates ------------------------------------------


@query
def rating_project(spark, sf_dir):
    return rounded(schema.rating_project(events_ratings(spark, sf_dir), "created_at"), "rating")


@query
def action_filter(spark, sf_dir):
    return interactions.action_filter(events_log(spark, sf_dir), schema.BUY).select("event_id", "user_id", "item_id")


@query
def exclusion_settings(spark, sf_dir):
    return exclusions.exclusion_settings(exclusion_rules(spark, sf_dir))


def stored(spark, df: DataFrame) -> DataFrame:
    """``df`` as the jobs find it: a table in storage."""
    target = Table(scratch_path(spark, "stored"))
    table_overwrite(df, target)
    return table_scan(spark, target)


@query
def exclusion_filter(spark, sf_dir):
    kept = exclusions.exclusion_filter(
        stored(spark, orders_ratings(spark, sf_dir)), orders_items(spark, sf_dir), exclusion_rules(spark, sf_dir)
    )
    return rounded(kept.select("user_id", "item_id", "rating"), "rating")


@query
def exclusion_filter_missing_items(spark, sf_dir):
    """With category rules, an item that the item table lacks is dropped."""
    rules = exclusion_rules(spark, sf_dir).where(F.col("object_type") == schema.CATEGORY_RULE)
    early = dims.item_dim(orders_log(spark, sf_dir).where(F.col("action") == schema.VIEW))
    kept = exclusions.exclusion_filter(stored(spark, orders_ratings(spark, sf_dir)), early, rules)
    return rounded(kept.select("user_id", "item_id", "rating"), "rating")


@query
def recency_filter(spark, sf_dir):
    recent = interactions.recency_filter(events_ratings(spark, sf_dir), day_ago(F.lit(AS_OF)))
    return recent.select("user_id", "item_id", "updated_at")


@query
def active_users(spark, sf_dir):
    return interactions.active_users(events_ratings(spark, sf_dir), day_ago(F.lit(AS_OF)))


@query
def buyer_filter(spark, sf_dir):
    ratings = events_ratings(spark, sf_dir)
    sides = [
        interactions.buyer_filter(ratings, bought).select("user_id", "item_id", F.lit(bought).alias("bought"))
        for bought in (True, False)
    ]
    return interactions.union_all(*sides)


@query
def match_filter(spark, sf_dir):
    found = selection.match_filter(events_log(spark, sf_dir), {"action": None, "item_id": 7})
    return found.select("event_id", "user_id", "item_id")


@query
def operator_filter(spark, sf_dir):
    found = selection.operator_filter(
        events_log(spark, sf_dir),
        [
            ("action", "$ne", schema.VIEW),
            ("created_at", "$gte", MIDDLE),
            ("created_at", "$lt", AS_OF),
            ("item_id", "$nin", [3, 5, 8]),
            ("item_id", "$gt", 1),
            ("user_id", "$lte", 100),
            ("action", "$in", [schema.CART, schema.BUY, None]),
        ],
    )
    return found.select("event_id", "user_id", "item_id", "action")


@query
def delete_where(spark, sf_dir):
    kept = selection.delete_where(events_log(spark, sf_dir), {"action": schema.VIEW, "item_id": 7})
    return kept.select("event_id", "item_id", "action")


@query
def update_where(spark, sf_dir):
    changed = selection.update_where(
        events_log(spark, sf_dir), {"action": None}, {"action": 9, "value": 0.0}
    )
    return rounded(changed.select("event_id", "action", "value"), "value")


# --- aggregations and set operations -------------------------------------------


@query
def action_counts(spark, sf_dir):
    return interactions.action_counts(events_log(spark, sf_dir))


@query
def affinity_rating(spark, sf_dir):
    counts = interactions.action_counts(events_log(spark, sf_dir))
    return rounded(interactions.affinity_rating(counts), "rating")


@query
def affinity_rating_orders(spark, sf_dir):
    return rounded(orders_ratings(spark, sf_dir), "rating")


@query
def interaction_times(spark, sf_dir):
    return interactions.interaction_times(events_log(spark, sf_dir))


@query
def user_dim(spark, sf_dir):
    return dims.user_dim(orders_log(spark, sf_dir))


@query
def item_dim(spark, sf_dir):
    return orders_items(spark, sf_dir)


@query
def user_purchase_profile(spark, sf_dir):
    return dims.user_purchase_profile(events_ratings(spark, sf_dir))


@query
def user_purchase_profile_orders(spark, sf_dir):
    return dims.user_purchase_profile(orders_ratings(spark, sf_dir))


@query
def sample_stats(spark, sf_dir):
    return evaluation.sample_stats(events_ratings(spark, sf_dir))


@query
def split_counts(spark, sf_dir):
    return evaluation.split_counts(split_ratings(spark, sf_dir))


@query
def mean_rating(spark, sf_dir):
    return rounded(evaluation.mean_rating(split_ratings(spark, sf_dir)), "mean_rating")


@query
def baseline_rmse(spark, sf_dir):
    return rounded(evaluation.baseline_rmse(split_ratings(spark, sf_dir)), "mean_rating", "baseline_rmse")


def item_means(ratings: DataFrame) -> DataFrame:
    """A simple predictor: the item's mean over train and validation."""
    return (
        ratings.where(F.col("split") != TEST)
        .groupBy("item_id")
        .agg(F.avg("rating").alias("prediction"), F.count(F.lit(1)).alias("n"))
    )


def scored_test(spark, sf_dir) -> DataFrame:
    ratings = split_ratings(spark, sf_dir)
    test = ratings.where(F.col("split") == TEST).select("user_id", "item_id", "rating")
    predictions = test.select("user_id", "item_id").join(item_means(ratings), "item_id").drop("n")
    return evaluation.prediction_join(test, predictions)


@query
def prediction_join(spark, sf_dir):
    return rounded(scored_test(spark, sf_dir), "rating", "prediction")


@query
def rmse(spark, sf_dir):
    return rounded(evaluation.rmse(scored_test(spark, sf_dir)), "rmse")


@query
def improvement_pct(spark, sf_dir):
    error = evaluation.rmse(scored_test(spark, sf_dir)).scalar()
    base = evaluation.baseline_rmse(split_ratings(spark, sf_dir))
    gain = evaluation.improvement_pct(F.col("baseline_rmse"), error)
    return base.select(F.round(gain, 6).alias("improvement_pct"))


@query
def best_params(spark, sf_dir):
    """The damping of the item means that predicts the test split best."""
    ratings = split_ratings(spark, sf_dir)
    damping = F.posexplode(F.array(*[F.lit(float(d)) for d in (0, 1, 2, 5, 10, 50)])).alias("trial", "damping")
    test = ratings.where(F.col("split") == TEST).select("item_id", "rating")
    mean = evaluation.mean_rating(ratings).scalar()
    damped = (F.col("prediction") * F.col("n") + mean * F.col("damping")) / (F.col("n") + F.col("damping"))
    scored = test.join(item_means(ratings), "item_id").select("*", damping).withColumn("prediction", damped)
    metrics = scored.groupBy("trial", "damping").agg(
        F.round(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))), 6).alias("rmse")
    )
    return evaluation.best_params(metrics, ["damping"])


@query
def union_all(spark, sf_dir):
    narrow = schema.rating_project(events_ratings(spark, sf_dir))
    wide = schema.rating_project(orders_ratings(spark, sf_dir))
    return rounded(interactions.union_all(narrow, wide), "rating")


@query
def distinct_users(spark, sf_dir):
    return interactions.distinct_users(events_log(spark, sf_dir))


@query
def distinct_items(spark, sf_dir):
    return interactions.distinct_items(events_log(spark, sf_dir))


# --- scalar expressions ----------------------------------------------------------


@query
def split_bucket(spark, sf_dir):
    bucket = bucket_of(F.col("created_at"))
    return events_log(spark, sf_dir).select("event_id", bucket.alias("bucket"), split_of(bucket).alias("split"))


@query_named("clamp")
def clamp_value(spark, sf_dir):
    return events_log(spark, sf_dir).select("event_id", clamp(F.col("value")).alias("clamped"))


@query_named("flag_positive")
def flag_positive_count(spark, sf_dir):
    counts = interactions.action_counts(events_log(spark, sf_dir))
    return counts.select(*interactions.PAIR, flag_positive(F.col("bought_count")).alias("bought"))


@query_named("join_ids")
def join_ids_text(spark, sf_dir):
    return dims.ids_per_key(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_partkey"), "ids")


@query_named("parse_event")
def parse_event_text(spark, sf_dir):
    return parse_event(message_text(spark, sf_dir))


@query_named("render_recs_json")
def render_recs_json_text(spark, sf_dir):
    every = vectors(spark, sf_dir)
    recs = rounded(topk.topk_items_per_user(every, every, TOP_N), "rating", digits=3)
    return topk.recs_nest(recs).select(
        "user_id", render_recs_json(F.col("user_id"), F.col("recommendations")).alias("message")
    )


@query_named("epoch_bounds")
def epoch_bounds_of_events(spark, sf_dir):
    return events_log(spark, sf_dir).select("event_id", *epoch_bounds(F.col("created_at")))


# --- top-k -----------------------------------------------------------------------


@query
def topk_items_per_user(spark, sf_dir):
    every = vectors(spark, sf_dir)
    return rounded(topk.topk_items_per_user(every, every, TOP_N), "rating")


@query
def topk_users_per_item(spark, sf_dir):
    every = vectors(spark, sf_dir)
    return rounded(topk.topk_users_per_item(every, every, TOP_N), "rating")


@query
def topk_for_users(spark, sf_dir):
    every = vectors(spark, sf_dir)
    wanted = events_log(spark, sf_dir).select("user_id")
    return rounded(topk.topk_for_users(every, every, wanted, TOP_N), "rating")


@query
def recs_flatten(spark, sf_dir):
    every = vectors(spark, sf_dir)
    nested = topk.recs_nest(topk.topk_items_per_user(every, every, TOP_N))
    return rounded(topk.recs_flatten(nested, F.lit(AS_OF)), "rating")


@query
def score_all_pairs(spark, sf_dir):
    every = vectors(spark, sf_dir)
    return rounded(topk.score_all_pairs(every, every), "min_score", "max_score", "mean_score")


# --- model: what must hold for a trained result, as flags ---------------------------


def wide_split(spark, sf_dir) -> DataFrame:
    return evaluation.assign_split(timed_ratings(spark, sf_dir))


def wide_pairs(spark, sf_dir) -> DataFrame:
    """The pairs of the orders, computed once for all that is done with them."""
    return written(orders_ratings(spark, sf_dir).select("user_id", "item_id", "rating"))


@query
def als_train(spark, sf_dir):
    """A user's vector is the least-squares solution for the item vectors, so no factor has a slope left."""
    ratings, params = wide_pairs(spark, sf_dir), model.FIXED_PARAMS
    found = model.solution_residual(model.als_train(ratings, params), ratings, params.reg)
    return found.select("user_id", "n_ratings", "n_factors", (F.col("residual") < 1e-3).alias("solved"))


@query
def als_predict(spark, sf_dir):
    ratings = written(wide_split(spark, sf_dir).select("user_id", "item_id", "rating", "split"))
    trained = model.als_train(ratings.where(F.col("split") != TEST), model.FIXED_PARAMS)
    test = ratings.where(F.col("split") == TEST).select("user_id", "item_id", "rating")
    scored = model.scored_by_vectors(trained, model.als_predict(trained, test))
    exact = (F.abs(F.col("prediction") - F.col("dot")) < 1e-4).alias("exact")
    return rounded(scored.select("user_id", "item_id", "rating", exact), "rating")


@query
def als_grid_search(spark, sf_dir):
    """Every trial's error is that of its vectors, these solve their problems, and the best has the lowest error."""
    found = model.als_grid_search(written(wide_split(spark, sf_dir)), audit=True)
    return grid_facts(found.metrics_table(spark), found.best)


def grid_facts(metrics: DataFrame, best: model.Params) -> DataFrame:
    chosen = (F.col("rank") == best.rank) & (F.col("reg") == best.reg) & (F.col("iterations") == best.iterations)
    lowest = F.col("vector_rmse") == F.min("vector_rmse").over(Window.partitionBy())
    return model.audited(metrics).select("trial", "rank", "reg", "iterations", "error_holds", "solved", (chosen == lowest).alias("best_is_lowest"))


def report_facts(report: DataFrame) -> DataFrame:
    """Counts and baseline of a report, and whether setting, error and gain are consistent."""
    gain = (F.col("baseline_rmse") - F.col("test_rmse")) / F.col("baseline_rmse") * 100
    tuned = F.col("rank").isin(*model.RANKS) & F.col("reg").isin(*model.REGS) & F.col("iterations").isin(*model.ITERATIONS)
    sound = tuned & (F.col("test_rmse") < float("inf")) & (F.abs(gain - F.col("improvement_pct")) < 1e-9)
    out = report.withColumn("sound", sound).drop("rank", "reg", "iterations", "test_rmse", "improvement_pct")
    return rounded(out, "mean_rating", "baseline_rmse")


@query
def model_report(spark, sf_dir):
    ratings = written(wide_split(spark, sf_dir))
    return report_facts(model.model_report(ratings, model.als_grid_search(ratings)))


def trained_and_loaded(spark, pairs: DataFrame):
    path = scratch_path(spark, "model")
    trained = model.als_train(pairs, model.FIXED_PARAMS)
    model.model_save(trained, path)
    return trained, model.model_load(path)


@query
def model_save(spark, sf_dir):
    """Every stored vector equals the trained one."""
    trained, loaded = trained_and_loaded(spark, wide_pairs(spark, sf_dir))

    def compared(side: str, of) -> DataFrame:
        stored = of(loaded).select("id", F.col("features").alias("stored"))
        same = F.col("features") == F.col("stored")
        return of(trained).join(stored, "id").select(F.lit(side).alias("side"), "id", same.alias("same"))

    return compared("user", model.user_factors).unionByName(compared("item", model.item_factors))


@query
def model_load(spark, sf_dir):
    """The loaded model predicts what the trained one does."""
    pairs = wide_pairs(spark, sf_dir)
    trained, loaded = trained_and_loaded(spark, pairs)
    both = model.als_predict(loaded, model.als_predict(trained, pairs).withColumnRenamed("prediction", "first"))
    same = (F.col("first") == F.col("prediction")).alias("same")
    return rounded(both.select("user_id", "item_id", "rating", same), "rating")


# --- jobs ------------------------------------------------------------------------


def warehouse(spark, sf_dir):
    """Stored event ratings, the parts as item table, and the rules."""
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    table_overwrite(events_ratings(spark, sf_dir), tables[schema.RATING_TABLE])
    table_overwrite(part_items(spark, sf_dir), tables[schema.ITEM_TABLE])
    table_overwrite(exclusion_rules(spark, sf_dir), tables[schema.RULE_TABLE])
    return tables


@query_named("job_import")
def job_import_ratings(spark, sf_dir):
    return rounded(stored_ratings(spark, imported(spark, sf_dir)).select(*RATING_COLUMNS), "rating")


@query_named("job_import_raw")
def job_import_raw_profiles(spark, sf_dir):
    """Two imports, the second folded into the stored ratings."""
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    for half in (F.col("created_at") < MIDDLE, F.col("created_at") >= MIDDLE):
        job_import_raw(spark, csv_v2(spark, sf_dir, half), tables, incremental=True)
    return table_scan(spark, tables[schema.USER_TABLE])


def imported(spark, sf_dir):
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    job_import(spark, csv_v1(spark, sf_dir), tables)
    return tables


@query
def job_import_users(spark, sf_dir):
    """The first import's users; its log has no times, so of several profiles the least one."""
    return table_scan(spark, imported(spark, sf_dir)[schema.USER_TABLE])


@query
def job_import_items(spark, sf_dir):
    return table_scan(spark, imported(spark, sf_dir)[schema.ITEM_TABLE])


@query
def job_import_raw_items(spark, sf_dir):
    """The item table after two imports of the wide log, by the earliest row of an item."""
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    log = orders_log(spark, sf_dir)
    for odd in (0, 1):
        path = scratch_path(spark, "log-v2")
        half = log.where(F.col("user_id") % 2 == odd)
        half.select(
            F.col("user_id").alias("customer_id"), "item_id", F.col("cat_id").alias("category_id"), "brand_id", "action", F.col("created_at").alias("unix_created_at")
        ).write.option("header", True).csv(path)
        job_import_raw(spark, path, tables, with_items=True)
    return table_scan(spark, tables[schema.ITEM_TABLE])


def wide_warehouse(spark, sf_dir):
    """Stored ratings of the orders, enough items for the longest lists."""
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    table_overwrite(timed_ratings(spark, sf_dir), tables[schema.RATING_TABLE])
    table_overwrite(part_items(spark, sf_dir), tables[schema.ITEM_TABLE])
    table_overwrite(exclusion_rules(spark, sf_dir), tables[schema.RULE_TABLE])
    return tables


def list_facts(recs: DataFrame, allowed: DataFrame) -> DataFrame:
    """Per list: its size, and whether all its items are allowed and the scores fall with the rank."""
    known = allowed.select("item_id").distinct().withColumn("known", F.lit(True))
    before = F.lag("rating").over(Window.partitionBy("user_id", "created_at").orderBy("rank"))
    falls = F.coalesce(before >= F.col("rating") - 1e-8, F.lit(True))
    return (
        recs.withColumn("falls", falls)
        .join(known, "item_id", "left")
        .groupBy("user_id", "created_at")
        .agg(
            F.count_distinct("item_id").alias("n_items"),
            F.max("rank").alias("last_rank"),
            F.bool_and(F.col("known").isNotNull()).alias("allowed"),
            F.bool_and("falls").alias("falls"),
        )
    )


@query_named("job_train")
def job_train_report(spark, sf_dir):
    tables = wide_warehouse(spark, sf_dir)
    return report_facts(job_train(spark, tables, scratch_path(spark, "model")))


@query_named("job_offline")
def job_offline_lists(spark, sf_dir):
    tables = wide_warehouse(spark, sf_dir)
    job_offline(spark, tables, AS_OF)
    return list_facts(table_scan(spark, tables[schema.RECOMMENDATION_TABLE]), recommendable_ratings(spark, tables))


@query_named("job_incremental")
def job_incremental_lists(spark, sf_dir):
    """A refresh at the last change of a rating, over a table that holds an old list of one item for every user."""
    tables = wide_warehouse(spark, sf_dir)
    ratings = recommendable_ratings(spark, tables)
    old = ratings.groupBy("user_id").agg(F.min("item_id").alias("item_id"))
    old = old.withColumns({"rating": F.lit(1.0), "rank": F.lit(1)})
    table_overwrite(stamped(old, 0), tables[schema.RECOMMENDATION_TABLE])
    job_incremental(spark, tables, ratings.agg(F.max("updated_at")).first()[0])
    return list_facts(table_scan(spark, tables[schema.RECOMMENDATION_TABLE]), ratings)


def job_offline_recs(spark, sf_dir):
    tables = warehouse(spark, sf_dir)
    job_offline(spark, tables, AS_OF)
    return table_scan(spark, tables[schema.RECOMMENDATION_TABLE])


def job_incremental_recs(spark, sf_dir):
    tables = warehouse(spark, sf_dir)
    job_incremental(spark, tables, AS_OF)
    return table_scan(spark, tables[schema.RECOMMENDATION_TABLE])


def streamed_messages(spark, sf_dir, base: DataFrame) -> DataFrame:
    tables = file_warehouse(scratch_path(spark, "warehouse"))
    table_overwrite(base, tables[schema.RATING_TABLE])
    work, source = scratch_path(spark, "stream"), scratch_path(spark, "messages")
    message_text(spark, sf_dir).write.text(source)
    stream = job_stream(
        spark,
        tables,
        ("text", {"path": source}),
        ("parquet", {"path": f"{work}/published"}),
        work,
        available_now=True,
    )
    stream.awaitTermination()
    return spark.read.parquet(f"{work}/published")


@query_named("job_stream")
def job_stream_lists(spark, sf_dir):
    return message_facts(streamed_messages(spark, sf_dir, orders_ratings(spark, sf_dir)))


# --- what is certain about a trained result: who and what it covers ----------------


@query
def als_train_coverage(spark, sf_dir):
    trained = model.als_train(events_ratings(spark, sf_dir), model.FIXED_PARAMS)
    return model.item_factors(trained).select("id", F.size("features").alias("n_features"))


@query
def als_predict_coverage(spark, sf_dir):
    ratings = split_ratings(spark, sf_dir)
    trained = model.als_train(ratings.where(F.col("split") != TEST), model.FIXED_PARAMS)
    test = ratings.where(F.col("split") == TEST).select("user_id", "item_id", "rating")
    scored = rounded(model.als_predict(trained, test), "rating")
    return scored.select("user_id", "item_id", "rating", F.col("prediction").isNotNull().alias("scored"))


@query
def model_report_coverage(spark, sf_dir):
    with model.persisted(split_ratings(spark, sf_dir)) as ratings:
        report = model.model_report(ratings, model.als_grid_search(ratings, [model.FIXED_PARAMS]))
    report = report.drop("test_rmse", "improvement_pct", "reg")
    return rounded(report, "mean_rating", "baseline_rmse")


def list_sizes(recs: DataFrame) -> DataFrame:
    return recs.groupBy("user_id", "created_at").agg(
        F.count_distinct("item_id").alias("n_items"), F.max("rank").alias("last_rank")
    )


@query
def job_offline_coverage(spark, sf_dir):
    return list_sizes(job_offline_recs(spark, sf_dir))


@query
def job_incremental_coverage(spark, sf_dir):
    return list_sizes(job_incremental_recs(spark, sf_dir))


@query
def job_stream_coverage(spark, sf_dir):
    lists = F.from_json("value", "array<struct<user:long, product:long, rating:double>>")
    products = F.explode(lists).alias("r")
    return (
        streamed_messages(spark, sf_dir, events_ratings(spark, sf_dir))
        .select(products)
        .groupBy(F.col("r.user").alias("user_id"))
        .agg(F.count_distinct("r.product").alias("n_items"))
    )
