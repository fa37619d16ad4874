"""Registered queries: one function ``(spark, sf_dir) -> DataFrame`` per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.functions import keys, text
from almanac.models import classifiers, forest
from almanac.models.caching import cached
from almanac.operators import calendars, indexing, joins, keying, metrics, quantiles, reshape, routing, runlog, scaling, sparse, splits
from almanac.plans import digits, weather
from almanac.plans.inputs import daily, observations, runs, table, vectors
from almanac.sinks import tables
from almanac.sinks.files import write_csv
from almanac.sources import files
from almanac.staging import new_folder, stage
from almanac.streaming.listener import deliver, hand_over, listen, listen_once
from almanac.streaming.slots import count_slots, late_rows, slot_counts

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# The branch names of the two routing examples.
MINUTE_BRANCHES = ("dummy_task_1", "dummy_task_2")
RANDOM_BRANCHES = ("branch_a", "branch_b", "branch_c", "branch_d")

# Fixed value: the text a triggered run prints.
RECEIVED = "Remotely received value of %s for key=message"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def width(samples: DataFrame, column: str = "features") -> int:
    """Elements of the vectors, from the first row; rows of another width fail later.  An empty table has none."""
    first = samples.select(F.size(column)).first()
    return first[0] if first else 0


def classes(samples: DataFrame) -> int:
    """Labels run from 0 to this number less one."""
    return (samples.agg(F.max("label")).first()[0] or 0) + 1


# --- calendar features and joins -------------------------------------------------


@query
def daily_max(spark, sf):
    return daily(spark, sf)


@query
def day_of_year_features(spark, sf):
    return reshape.day_of_year(daily(spark, sf)).select("station", "tmax", "day_of_year")


@query
def yesterday_join(spark, sf):
    return joins.yesterday_join(daily(spark, sf))


@query
def lagged_features(spark, sf):
    """The training table: attributes of the station, day of year, the day's value and yesterday's."""
    lagged = reshape.day_of_year(joins.yesterday_join(observations(spark, sf)))
    # A float and a date are joined by key; the attributes come from the day itself.
    return lagged.select("station", "date", *forest.LAG_FEATURES[:3], "day_of_year", "tmax", "yesterday_tmax")


@query
def regression_metrics(spark, sf):
    return metrics.regression_metrics(joins.yesterday_join(daily(spark, sf)), "tmax", "yesterday_tmax")


@query
def align_features_labels(spark, sf):
    features = table(spark, sf, "documents").select("doc_id", "n_chars")
    return joins.align_on_key(features, table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


# --- reshape -----------------------------------------------------------------------


@query
def concat_tables(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("key"), F.lit("supplier").alias("kind")
    )
    return reshape.concat_tables(customers, suppliers)


@query
def parse_dates(spark, sf):
    written = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("d")
    )
    return reshape.parse_date(written, "d")


@query
def date_rejects(spark, sf):
    """Query values of page URLs that are no dates, next to order dates that are."""
    values = table(spark, sf, "pages").select(
        F.col("page_id").alias("key"), F.coalesce(text.url_param("url", "page"), F.lit("none")).alias("d")
    )
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderdate").cast("date").cast("string").alias("d")
    )
    good, bad = reshape.split_by_date(values.unionByName(orders), "d")
    dated = good.select("key", F.col("d").cast("string").alias("d"), F.lit(True).alias("is_date"))
    return dated.unionByName(bad.withColumn("is_date", F.lit(False)))


@query
def sql_over_this(spark, sf):
    return reshape.sql_over(
        table(spark, sf, "lineitem"),
        "SELECT l_returnflag, count(*) AS n FROM __THIS__ GROUP BY l_returnflag",
    )


@query
def head_rows(spark, sf):
    return reshape.first_rows(table(spark, sf, "events").select("event_id", "ts"), ["event_id"])


@query
def array_to_columns(spark, sf):
    embeddings = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return reshape.array_to_columns(embeddings, "embedding", width(embeddings, "embedding"))


@query
def columns_to_array(spark, sf):
    wide = array_to_columns(spark, sf)
    return reshape.columns_to_array(wide, [c for c in wide.columns if c != "vec_id"], "features")


@query
def flatten_vectors(spark, sf):
    """Vectors cut into four rows of a matrix, and flattened again."""
    embeddings = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    quarter = F.ceil(F.size("x") / 4).cast("int")
    matrix = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("x", i * quarter + 1, quarter))
    return embeddings.withColumn("matrix", matrix).select("vec_id", reshape.flatten_nested("matrix").alias("features"))


@query
def assemble_features(spark, sf):
    assembled = reshape.assemble_features(table(spark, sf, "customer"), ["c_nationkey", "c_acctbal"])
    return assembled.select("c_custkey", vector_to_array("features").alias("features"))


# --- indexes and splits ---------------------------------------------------------------


@query
def row_index(spark, sf):
    return indexing.with_row_index(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query
def permute_rows(spark, sf):
    return indexing.permuted(table(spark, sf, "embeddings").select("vec_id"), "vec_id", seed=0)


@query
def weighted_split(spark, sf):
    return splits.weighted_split(
        table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.75, "validation": 0.25}, seed=7
    )


@query
def exact_split(spark, sf):
    return splits.exact_split(
        table(spark, sf, "embeddings").select("vec_id", "label"), "vec_id", train_size=0.25, test_size=0.5, seed=0
    )


# --- routing --------------------------------------------------------------------------


@query
def route_by_minute(spark, sf):
    even, odd = MINUTE_BRANCHES
    events = table(spark, sf, "events")
    return routing.route(events, {even: routing.even_minute("ts")}, odd).select("event_id", "branch")


@query
def random_branch(spark, sf):
    events = table(spark, sf, "events").select("event_id")
    return routing.random_branch(events, "event_id", RANDOM_BRANCHES, seed=42)


@query
def gate_if(spark, sf):
    """Three gates over all orders: one closed, one open, one open if there are events."""
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    opened = routing.gate_if(orders, events.agg(F.count("*") > 0)).withColumn("g", F.lit("open"))
    closed = routing.gate_if(orders, events.agg(F.count("*") < 0)).withColumn("g", F.lit("closed"))
    found = routing.gate_nonempty(orders, events).withColumn("g", F.lit("nonempty"))
    return opened.unionByName(closed).unionByName(found)


@query
def build_payload(spark, sf):
    flag = text.json_int("props", "$.k") > 50
    return routing.trigger_payloads(table(spark, sf, "events"), flag, "event_type").select("event_id", "conf")


# --- run log ---------------------------------------------------------------------------


@query
def trigger_rules(spark, sf):
    day = F.col("ts").cast("date").alias("day")
    return runlog.trigger_rules(runs(spark, sf), ["user_id", day])


@query
def depends_on_past(spark, sf):
    return runlog.depends_on_past(runs(spark, sf), "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "eligible"
    )


@query
def latest_only(spark, sf):
    return runlog.latest_only(table(spark, sf, "events").select("event_id", "ts"), "ts", "4 hours")


@query
def schedule_grid(spark, sf):
    return runlog.schedule_grid(table(spark, sf, "events"), "ts", "4 hours", "event_id")


@query
def schedule_last_slot(spark, sf):
    return runlog.schedule_grid(table(spark, sf, "events"), "ts", "10 minutes", "event_id", catchup=False)


# Schedules of the calendar queries: hours on weekdays, days of the month or Mondays, every third minute of some hours,
# months by step, once, and presets.
CALENDARS = (
    "0 6,18 * * 1-5", "30 */8 1,15 * mon", "*/20 9-17/4 * jan,feb 0", "15 9 29 */2 *", "@once", "@weekly", "@monthly", "@yearly",
)


@query
def schedule_cron(spark, sf):
    """Events of each slot of several calendar schedules, empty slots included."""
    events = table(spark, sf, "events").select("ts", "event_id")
    grids = [
        calendars.schedule_slots(events, "ts", schedule, "event_id").select(F.lit(schedule).alias("schedule"), "slot", "n")
        for schedule in CALENDARS
    ]
    return reduce(DataFrame.unionByName, grids)


@query
def latest_per_key(spark, sf):
    messages = [F.col("event_type"), F.array("value").alias("latest_values")]
    return runlog.latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"], messages)


@query
def latest_map(spark, sf):
    """Newest map of each key, one row per entry."""
    message = F.create_map("event_type", F.col("value").cast("string")).alias("message")
    newest = runlog.latest_per_key(table(spark, sf, "events"), "user_id", ["ts", "event_id"], [message])
    return newest.select("user_id", F.inline(F.map_entries("message"))).withColumnRenamed("key", "name")


@query
def date_macros(spark, sf):
    return runlog.date_macros(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


# --- scalar functions --------------------------------------------------------------------


@query
def json_field_default(spark, sf):
    events = table(spark, sf, "events").select("event_id", "props")
    return text.with_json_fields(events, "props", ["k", "message"]).select(
        "event_id",
        F.col("k").try_cast("int").alias("k"),
        F.coalesce("message", F.lit("")).alias("message"),
    )


@query
def json_check(spark, sf):
    return table(spark, sf, "events").select("event_id", text.json_equals("props", "$.k", 5).alias("ok"))


@query
def text_check(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.has_text("html", "track(").alias("ok"))


@query
def url_params(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id",
        text.url_host("url").alias("host"),
        *[text.url_param("url", name).alias(name) for name in ("page", "ref", "utm_source")],
    )


@query
def form_fields(spark, sf):
    """The query part of each URL read as a form body."""
    body = F.try_parse_url(F.col("url"), F.lit("QUERY"))
    return table(spark, sf, "pages").select(
        "page_id", *[text.form_param(F.coalesce(body, F.lit("")), name).alias(name) for name in ("page", "ref")]
    )


@query
def render_message(spark, sf):
    message = text.render(RECEIVED, "event_type")
    return table(spark, sf, "events").select("event_id", message.alias("message"))


@query
def unique_surrogate_keys(spark, sf):
    """Surrogate keys of which no two are equal."""
    return keying.unique_surrogate_keys(table(spark, sf, "events").select("event_id"), "event_id")


@query
def surrogate_keys(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        keys.surrogate_key("event_id").alias("custom_id"),
        keys.user_token("event_id").alias("user_token"),
    )


# --- scaling and metrics ------------------------------------------------------------------


@query
def feature_stats(spark, sf):
    stats = scaling.feature_stats(table(spark, sf, "embeddings"), "embedding")
    return stats.select("pos", F.round("mean", 6).alias("m"), F.round("sd", 6).alias("sd"))


@query
def standardize(spark, sf):
    embeddings = table(spark, sf, "embeddings").select("vec_id", "embedding")
    scaled = scaling.standardize(embeddings, "embedding", scaling.fit_scaler(embeddings, "embedding"))
    return scaled.select("vec_id", F.posexplode_outer("scaled").alias("pos", "z")).withColumn("z", F.round("z", 6))


@query
def cached_shares(spark, sf):
    """Share of each event type; the events are kept in memory for two passes over them."""
    with cached(table(spark, sf, "events").select("event_type")) as kept:
        total = kept.count()
        counts = stage(kept.groupBy("event_type").agg(F.count("*").alias("n")), "event-types")
    return counts.withColumn("share", F.round(F.col("n") / F.lit(total), 6))


@query
def zero_share(spark, sf):
    weights = table(spark, sf, "embeddings").select(F.posexplode("embedding").alias("pos", "x"))
    value = F.when(F.abs(F.col("x").cast("double")) < 0.05, 0.0).otherwise(F.col("x").cast("double"))
    return weights.groupBy("pos").agg(metrics.share_of_zeros(value).alias("zero_pct"))


@query
def accuracy(spark, sf):
    return metrics.accuracy(table(spark, sf, "labels"), F.col("doc_id") % 2, "quality")


@query
def compare_predictors(spark, sf):
    labels = table(spark, sf, "labels")
    tall = metrics.tall_predictions(labels, {"parity": F.col("doc_id") % 2, "one": F.lit(1)})
    return metrics.compare_predictors(tall, "quality")


def thinned(spark: SparkSession, sf: str) -> DataFrame:
    """(id, label, features): vectors in which weights below 0.05 are 0, in dense form."""
    weight = lambda x: F.when(F.abs(x.cast("double")) < 0.05, 0.0).otherwise(x.cast("double"))
    return vectors(spark, sf).select("id", "label", F.transform("features", weight).alias("features"))


def sparse_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return thinned(spark, sf).withColumn("features", sparse.to_sparse("features"))


@query
def sparse_feature_stats(spark, sf):
    stats = sparse.sparse_feature_stats(sparse_vectors(spark, sf), "features")
    return stats.select("pos", F.round("mean", 6).alias("m"), F.round("sd", 6).alias("sd"))


@query
def sparse_zero_share(spark, sf):
    return sparse.sparse_zero_share(sparse_vectors(spark, sf), "features")


@query
def sparse_products(spark, sf):
    """Inner product of each standardised vector with falling weights; no vector is filled in."""
    samples = sparse_vectors(spark, sf)
    stats = stage(sparse.sparse_feature_stats(samples, "features"), "sparse-stats")
    weights = stats.select("pos", (1.0 / (F.col("pos") + 1)).alias("weight"))
    products = sparse.standardized_products(samples, "id", "features", stats, weights)
    return products.select("id", F.round("product", 6).alias("product"))


@query
def sparse_csv(spark, sf):
    """Vectors through wide numeric files; the numbers that are not zero are read back."""
    folder = new_folder(spark, "sparse-csv")
    samples = thinned(spark, sf)
    wide = width(samples)
    write_csv(reshape.array_to_columns(samples, "features", wide), folder)
    read = files.read_sparse_csv(spark, folder, wide, samples.select("id", "label").schema)
    return sparse.entries(read, "features", "id", "label")


# --- files and tables ---------------------------------------------------------------------


@query
def station_csv(spark, sf):
    """Observations through headerless gzip files and back."""
    folder = new_folder(spark, "station-csv")
    write_csv(observations(spark, sf), folder, header=False, compression="gzip")
    return files.read_station_csv(spark, folder)


@query
def typed_csv(spark, sf):
    """Observations through files with a header and back."""
    folder = new_folder(spark, "typed-csv")
    write_csv(observations(spark, sf), folder)
    return files.read_typed_csv(spark, folder)


@query
def indexed_csv(spark, sf):
    """Orders written with a leading row number and read back."""
    folder = new_folder(spark, "indexed-csv")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    write_csv(orders, folder, index_by=["o_orderkey"])
    fields = [T.StructField("idx", T.LongType()), *orders.schema.fields]
    return files.read_typed_csv(spark, folder, T.StructType(fields))


@query
def matrix_csv(spark, sf):
    """Vectors through wide numeric files and back; id and label stay key columns."""
    folder = new_folder(spark, "matrix-csv")
    samples = vectors(spark, sf).select("id", "label", "features")
    wide = width(samples)
    write_csv(reshape.array_to_columns(samples, "features", wide), folder)
    return files.read_matrix_csv(spark, folder, wide, samples.select("id", "label").schema)


@query
def not_null_violations(spark, sf):
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    messages = events.select("event_id", F.get_json_object("props", "$.message").alias("message"))
    return tables.null_violations(orders, orders.columns, "orders").unionByName(
        tables.null_violations(messages, messages.columns, "messages")
    )


@query
def append_rows(spark, sf):
    """Create a NOT NULL table twice, append one row per event, read it back."""
    folder = new_folder(spark, "sink-table")
    name = "almanac_" + folder.rsplit("-", 1)[-1]
    tables.create_table(spark, name, location=folder)
    tables.create_table(spark, name, location=folder)
    rows = table(spark, sf, "events").select(
        keys.surrogate_key("event_id").alias("custom_id"),
        F.col("ts").alias("timestamp"),
        keys.user_token("event_id").alias("user_id"),
    )
    tables.append_rows(rows, name, required=rows.columns)
    schema = spark.table(name).schema
    spark.sql(f"DROP TABLE {tables.qualified(name)}")  # the files stay
    return spark.read.schema(schema).parquet(folder)


@query
def directory_listener(spark, sf):
    """Events dropped as JSON files into a directory and picked up by a stream."""
    inbox, sink = new_folder(spark, "inbox"), new_folder(spark, "listened")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    events.write.json(inbox)
    stream = listen(
        spark, inbox, new_folder(spark, "archive"), events.schema, "json", files_per_trigger=1000
    )
    deliver(stream, sink, every=None).awaitTermination()
    listened = spark.read.schema(stream.schema).parquet(sink)
    # A row for each event, and whether its file's name has been kept.
    named = F.col("file_name").rlike(r"^part-.*\.json$").alias("named")
    return listened.select("event_id", "user_id", "event_type", "value", named)


@query
def listener_ledger(spark, sf):
    """Events handed over file by file, counted by kind over the files that the ledger lists; no file may stay behind."""
    inbox, sink, ledger, archive = (new_folder(spark, name) for name in ("inbox", "handed-over", "ledger", "archive"))
    events = table(spark, sf, "events").select("event_id", "event_type")
    events.repartition(8, "event_id").write.json(inbox)
    stream = listen_once(spark, inbox, events.schema, "json", files_per_trigger=3)
    hand_over(stream, sink, ledger, archive, new_folder(spark, "ledger-checkpoint"), every=None).awaitTermination()
    listed = spark.read.parquet(ledger).select("file_name", "n")
    taken = spark.read.schema(stream.schema).parquet(sink).join(listed, "file_name").groupBy("event_type").agg(F.count("*").alias("n"))
    archived = spark.read.schema(events.schema).json(archive).groupBy("event_type").agg(F.count("*").alias("archived"))
    return taken.join(archived, "event_type").select("event_type", "n", "archived")


@query
def streamed_slots(spark, sf):
    """Events counted in slots of 4 hours as they arrive; errors come a delivery later, those of closed slots too late."""
    inbox, sink, late, checkpoint = (new_folder(spark, name) for name in ("slots-inbox", "slots", "late", "slots-checkpoint"))
    events = table(spark, sf, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    for delivery in (events.where("event_type <> 'error'"), events.where("event_type = 'error' OR event_type IS NULL")):
        delivery.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 100_000).parquet(inbox)
        count_slots(stream, "ts", "4 hours", "10 days", sink, late, checkpoint, trigger=None).awaitTermination()
    slot = F.window("ts", "4 hours")["start"].alias("slot")
    missed = late_rows(spark, late).groupBy(slot).agg(F.count("*").alias("late"))
    return slot_counts(spark, sink).join(missed, "slot", "full").select(
        F.col("slot").cast("timestamp_ntz").alias("slot"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("late", F.lit(0)).alias("late")
    )


# --- fitted models ------------------------------------------------------------------------


@query
def forest_forecast(spark, sf):
    """Forecasts for the held-out quarter of the observations."""
    return weather.forecast(observations(spark, sf))


@query
def forest_validation(spark, sf):
    return metrics.regression_metrics(forest_forecast(spark, sf), "tmax", "prediction")


@query
def forest_forecast_lagged(spark, sf):
    """The same with yesterday's value in place of the season."""
    lagged = joins.yesterday_join(observations(spark, sf))
    return weather.forecast(lagged, forest.LAG_FEATURES)


@query
def forest_trees(spark, sf):
    """The nodes of the trees that forecast by season."""
    return weather.grow(observations(spark, sf)).table(spark)


@query
def key_ranges(spark, sf):
    """Even ranges of two key columns, and how many rows each holds."""

    def of(source: str, key: str) -> DataFrame:
        rows = table(spark, sf, source).select(F.col(key).cast("bigint").alias("key"))
        return quantiles.key_ranges(rows, "key", 16).select(F.lit(source).alias("source"), "*")

    return of("orders", "o_orderkey").unionByName(of("events", "user_id")).unionByName(of("lineitem", "l_partkey"))


def estimators(samples: DataFrame) -> dict[str, Estimator]:
    k = classes(samples)
    return {
        "l1_logistic": classifiers.l1_logistic(),
        "l1_hinge": classifiers.l1_hinge(k),
        "linear_svc": classifiers.linear_svc(),
        "mlp": classifiers.perceptron([width(samples), 16, k]),
    }


def classified(spark: SparkSession, sf: str, name: str) -> DataFrame:
    samples = vectors(spark, sf)
    return digits.classify(samples, estimators(samples)[name])


@query
def l1_classifier(spark, sf):
    return classified(spark, sf, "l1_logistic")


@query
def l1_hinge_classifier(spark, sf):
    return classified(spark, sf, "l1_hinge")


@query
def linear_svc_classifier(spark, sf):
    return classified(spark, sf, "linear_svc")


@query
def mlp_classifier(spark, sf):
    return classified(spark, sf, "mlp")


@query
def stochastic_hinge_classifier(spark, sf):
    """Classes by the hinge objective, from a few stochastic passes."""
    samples = vectors(spark, sf)
    return digits.classify(samples, classifiers.stochastic_l1_hinge(classes(samples)))


@query
def saga_classifier(spark, sf):
    """Classes by the L1 logistic objective, from variance-reduced steps."""
    samples = vectors(spark, sf)
    return digits.classify(samples, classifiers.saga_l1_logistic(classes(samples)))


@query
def saga_optimality(spark, sf):
    """Each coefficient with the gradient that the training rows give it, and how far it is from the optimum's conditions."""
    samples = vectors(spark, sf)
    train, _ = digits.train_and_test(samples)
    model = classifiers.fit_models(train, {"saga": classifiers.saga_l1_logistic(classes(samples))})["saga"]
    return classifiers.optimality(model, train)


@query
def score_models(spark, sf):
    samples = vectors(spark, sf)
    chosen = {name: e for name, e in estimators(samples).items() if name.startswith("l1")}
    return digits.compare_saved(samples, chosen, new_folder(spark, "models"))


@query
def classifier_rows(spark, sf):
    """Every held-out row by every classifier: is the class in range, and the same after saving and loading?"""
    samples, k = vectors(spark, sf), classes(vectors(spark, sf))
    chosen = estimators(samples) | {"mlp": classifiers.packed_perceptron([width(samples), 16, k])}
    return digits.reload_check(samples, chosen, new_folder(spark, "models"), k)


@query
def linear_margins(spark, sf):
    """Held-out rows: is the prediction the one that the coefficient table gives?"""
    samples = vectors(spark, sf)
    chosen = {name: e for name, e in estimators(samples).items() if name.startswith("l1")}
    return digits.recomputed(samples, chosen)


@query
def model_scaler(spark, sf):
    """Mean and deviation of each feature, from a model that has been saved and loaded."""
    samples = vectors(spark, sf)
    return digits.saved_scaler(samples, classifiers.l1_logistic(), new_folder(spark, "models"))


@query
def forest_holdout(spark, sf):
    """The held-out observations, each with a finite forecast?"""
    forecast = forest_forecast(spark, sf)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return forecast.select("station", "date", "tmax", finite.alias("finite"))
