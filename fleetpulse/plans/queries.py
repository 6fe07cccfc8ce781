"""The operators bound to the check tables, each with its SQL where SQL can say it.

``events`` stands in for telemetry: the user is the turbine, ``value`` the power,
and a quarter of the number in ``props`` the wind speed. Negative power, missing
wind, missing times and missing ids are made from the table's own columns so that
every cleaning rule has rows to act on.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields
from typing import Any

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.trees import (
    Tree,
    slots_below,
    tabulate,
    unsplit_tree,
)
from fleetpulse.operators.fleet import combine_flags, drop_faulty, rate_turbines
from fleetpulse.operators.forest import (
    ForestModel,
    flag_above_quantile,
    flag_outliers,
    outlier_score,
)
from fleetpulse.operators.power import (
    flag_zscore,
    round_power,
    with_expected_power,
    with_residual,
)
from fleetpulse.operators.silver import (
    assign_site_ids,
    clean_readings,
    merge_feeds,
    standardize_site_feed,
    void_negative_power,
)
from fleetpulse.operators.summary import summarize_power
from fleetpulse.params import Params
from fleetpulse.plans.pipeline import (
    Gold,
    Layers,
    build_gold,
    run_all,
    run_bronze,
    run_gold,
    run_silver,
)
from fleetpulse.sources.staging import discard, fresh_path, stage
from fleetpulse.sources.tables import drop_schemas

Query = Callable[[SparkSession, str], DataFrame]

ROW_KEY = ("event_id",)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def props_number() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("double")


def wind() -> Column:
    return props_number() * 0.25


def is_error() -> Column:
    return F.when(F.col("event_type") == "error", 1).otherwise(0)


def event_readings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("turbine_id"),
        F.col("ts").alias("timestamp"),
        wind().alias("wind_speed"),
        F.col("value").alias("power_output"),
    )


def rated_units(spark: SparkSession, folder: str) -> DataFrame:
    """Turbine days, small enough that all three ratings occur; NULL ids included."""
    user = F.nullif(F.col("user_id"), F.lit(7))
    return table(spark, folder, "events").select(
        "event_id", (user * 100 + F.day("ts")).alias("unit_id"), is_error().alias("flag")
    )


def q_clean_readings(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "events").select(
        "event_id",
        F.col("user_id").alias("turbine_id"),
        F.when(F.col("event_id") % 97 != 0, F.col("ts")).alias("timestamp"),
        F.when(F.col("event_type") != "signup", wind()).alias("wind_speed"),
        (F.col("value") - 25).alias("power_output"),
    )
    return clean_readings(raw)


def q_expected_power(spark: SparkSession, folder: str) -> DataFrame:
    powered = with_residual(with_expected_power(event_readings(spark, folder)))
    return powered.select(
        "event_id",
        F.round("expected_power", 6).alias("expected_power"),
        F.round("error", 6).alias("error"),
    )


def site_rows(events: DataFrame) -> DataFrame:
    """Events in the raw layout of the site feed."""
    number = props_number()
    return events.select(
        "event_id",
        "event_type",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Time"),
        number.alias("temperature_2m"),
        number.alias("relativehumidity_2m"),
        number.alias("dewpoint_2m"),
        F.col("value").alias("windspeed_10m"),
        F.col("value").alias("windspeed_100m"),
        number.alias("winddirection_10m"),
        (number * 3.0).alias("winddirection_100m"),
        F.col("value").alias("windgusts_10m"),
        (number * 0.01).alias("Power"),
    )


def q_site_feed_standardized(spark: SparkSession, folder: str) -> DataFrame:
    feed = standardize_site_feed(site_rows(table(spark, folder, "events")))
    return feed.select(
        "event_id",
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.round("power_output", 6).alias("power_output"),
        "wind_speed",
        "wind_direction",
    )


def q_site_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = F.when(F.col("event_id") % 11 == 0, "/in/LocationX.csv").otherwise(
        F.concat(F.lit("/in/location"), F.col("user_id"), F.lit(".csv"))
    )
    sites = table(spark, folder, "events").select("event_id", path.alias("source_file"))
    fleet = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("turbine_id"))
    numbered = assign_site_ids(sites, fleet)
    return numbered.select("event_id", F.col("turbine_id").cast("long").alias("turbine_id"))


def q_merged_feeds(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    lines = table(spark, folder, "lineitem")
    calm = F.lit(0.0).alias("wind_speed")
    fleet = events.select(
        F.col("user_id").alias("turbine_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("power_output"),
        calm,
    )
    sites = lines.select(
        F.col("l_extendedprice").alias("power_output"),
        calm,
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_suppkey").alias("turbine_id"),
    )
    return merge_feeds(fleet, sites).drop("wind_speed")


def q_zscore_flags(spark: SparkSession, folder: str) -> DataFrame:
    powered = with_expected_power(event_readings(spark, folder))
    return flag_zscore(powered).select("event_id", "z_anomaly")


def q_combined_flags(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    z_flag = F.when(F.col("value") > 100, 1).otherwise(0)
    flags = table(spark, folder, "events").select(
        "event_id",
        F.when(kind != "signup", z_flag).alias("z_anomaly"),
        F.when(kind != "view", is_error()).alias("if_anomaly"),
    )
    return combine_flags(flags).select("event_id", "combined_anomaly")


def q_unit_status(spark: SparkSession, folder: str) -> DataFrame:
    return rate_turbines(rated_units(spark, folder), key="unit_id", flag="flag")


def q_healthy_readings(spark: SparkSession, folder: str) -> DataFrame:
    units = rated_units(spark, folder)
    healthy = drop_faulty(units, rate_turbines(units, key="unit_id", flag="flag"), "unit_id")
    return healthy.select("event_id", "unit_id", "turbine_status")


def q_daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize_power(event_readings(spark, folder))


@dataclass(frozen=True)
class FixedForest:
    """Two trees written by hand: wind <= ``wind``: 3, else power <= ``low``: 4, else 1;
    and power <= ``high``: 4, else 1."""

    wind: float
    low: float
    high: float

    def model(self) -> ForestModel:
        wind_speed, power = 0, 1
        first, second = unsplit_tree(2), unsplit_tree(2)
        _split(first, 0, wind_speed, self.wind)
        _split(first, 2, power, self.low)
        _split(second, 0, power, self.high)
        for tree, node, level, length in (
            (first, 1, 1, 3.0),
            (first, 5, 2, 4.0),
            (first, 6, 2, 1.0),
            (second, 1, 1, 4.0),
            (second, 2, 1, 1.0),
        ):
            tree.path[slots_below(node, level, 2)] = length
        trees = tuple(tabulate(tree, 2) for tree in (first, second))
        return ForestModel(("wind_speed", "power_output"), 256, trees)

    def depth_sql(self) -> str:
        """The sum of both path lengths of a row with wind ``w`` and power ``p``."""
        return (
            f"(CASE WHEN w <= {self.wind} THEN 3 WHEN p <= {self.low} THEN 4 ELSE 1 END"
            f" + CASE WHEN p <= {self.high} THEN 4 ELSE 1 END)"
        )


# For power from event values, from line prices, and from what the raw files hold.
EVENT_FOREST = FixedForest(5.0, 60.0, 150.0)
LINE_FOREST = FixedForest(45.0, 60_000.0, 80_000.0)
FILE_FOREST = FixedForest(5.0, 20.0, 120.0)


def _split(tree: Tree, node: int, feature: int, threshold: float) -> None:
    tree.feature[node], tree.threshold[node] = feature, np.float64(threshold)


def q_forest_scores_fixed_model(spark: SparkSession, folder: str) -> DataFrame:
    scored = outlier_score(event_readings(spark, folder), EVENT_FOREST.model())
    rounded = scored.select("event_id", F.round("score", 9).alias("score"))
    ranked = owned(stage(rounded, "fixed-scores")).frame.withColumn("rank", F.col("score"))
    return flag_above_quantile(ranked, column="rank")


def q_score_cut(spark: SparkSession, folder: str) -> DataFrame:
    """The forest's cut on a column where nearly every value is different."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("score"),
    )
    return flag_above_quantile(lines)


def q_forest_flags(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any grown forest: every row is flagged or not, no more than the
    share are, and rows moved far from all others (ids divisible by 100) all are."""
    far = F.col("event_id") % 100 == 0
    readings = event_readings(spark, folder).withColumns(
        {
            "wind_speed": F.when(far, F.col("wind_speed") + 900.0).otherwise(F.col("wind_speed")),
            "power_output": F.when(far, -9e9).otherwise(F.col("power_output")),
        }
    )
    flagged = owned(flag_outliers(with_expected_power(readings), key=ROW_KEY)).frame
    return flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.sum("if_anomaly") <= F.ceil(F.count(F.lit(1)) * 0.15)).alias("within_share"),
        F.sum(F.when(far, F.col("if_anomaly"))).alias("n_far_flagged"),
    )


def q_gold_chain_surrogate(spark: SparkSession, folder: str) -> DataFrame:
    """The gold layer with error events in place of the forest's flags."""
    params = Params(faulty_rate=0.35, review_rate=0.22)
    raw = table(spark, folder, "events").select(
        F.col("user_id").alias("turbine_id"),
        F.col("ts").alias("timestamp"),
        wind().alias("wind_speed"),
        (F.col("value") * 0.37 - 3).alias("power_output"),
        is_error().alias("if_anomaly"),
    )
    powered = with_expected_power(clean_readings(raw), params)
    rows = combine_flags(round_power(flag_zscore(powered, params)))
    ratings = rate_turbines(rows, params)
    return drop_faulty(summarize_power(rows, params), ratings).drop("turbine_status")


# Shares that tell the turbines of the gold queries apart, so that every status occurs.
GOLD_PARAMS = Params(faulty_rate=0.3, review_rate=0.2)


def _event_gold(spark: SparkSession, folder: str) -> Gold:
    readings = clean_readings(event_readings(spark, folder))
    return owned(build_gold(readings, GOLD_PARAMS, model=EVENT_FOREST.model()))


def q_gold_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _event_gold(spark, folder).ratings


def q_gold_analysis(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("event_id", "turbine_id", "power_output", "z_anomaly", "if_anomaly")
    analysis = _event_gold(spark, folder).analysis
    return analysis.select(*columns, "combined_anomaly", "turbine_status")


def q_gold_pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return _event_gold(spark, folder).summary


def q_lineitem_gold(spark: SparkSession, folder: str) -> DataFrame:
    """The gold layer over the largest table: suppliers as turbines."""
    readings = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("turbine_id"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_quantity").alias("wind_speed"),
        F.col("l_extendedprice").alias("power_output"),
    )
    return owned(build_gold(clean_readings(readings), model=LINE_FOREST.model())).summary


def write_raw_files(events: DataFrame, folder: str) -> None:
    """Views become the fleet feed, every other event type a site of its own.

    Sites are numbered in the order of their types; their files' names differ in case.
    """
    views = events.where(F.col("event_type") == "view").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").alias("turbine_id"),
        wind().alias("wind_speed"),
        (props_number() * 3.0).alias("wind_direction"),
        (F.col("value") - 25).alias("power_output"),
    )
    views.write.option("header", True).csv(f"{folder}/data_group_1.csv")
    sites = site_rows(events)
    kinds = events.where(F.col("event_type") != "view").select("event_type").distinct()
    for number, row in enumerate(kinds.orderBy("event_type").collect(), start=1):
        rows = sites.where(F.col("event_type") == row["event_type"])
        name = ("Location", "location", "LOCATION")[number % 3]
        rows.drop("event_id", "event_type").write.option("header", True).csv(
            f"{folder}/{name}{number}.csv"
        )


@dataclass(frozen=True)
class OwnLayers:
    """Layers of one run alone, with all files in the shared folder."""

    spark: SparkSession
    layers: Layers

    @property
    def raw(self) -> str:
        return f"{self.layers.root}/raw"

    def release(self) -> None:
        drop_schemas(self.spark, self.layers.bronze, self.layers.silver, self.layers.gold)
        discard(self.spark, self.layers.root)


def _own_layers(
    spark: SparkSession,
    folder: str,
    write: Callable[[DataFrame, str], None] | None = None,
    catalog: str | None = None,
) -> OwnLayers:
    run = uuid.uuid4().hex
    names = (f"{layer}_{run}" for layer in ("bronze", "silver", "gold"))
    layers = Layers(*names, root=fresh_path(spark, "layers"), catalog=catalog)
    own = owned(OwnLayers(spark, layers))
    (write or write_raw_files)(table(spark, folder, "events"), own.raw)
    return own


def q_files_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Raw CSV files through both bronze tables to the silver table."""
    own = _own_layers(spark, folder)
    run_bronze(spark, own.raw, own.layers)
    run_silver(spark, layers=own.layers)
    return spark.table(own.layers.readings).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("turbine_id").cast("long").alias("turbine_id"),
        "wind_speed",
        "wind_direction",
        F.round("power_output", 6).alias("power_output"),
    )


def _run_files(spark: SparkSession, folder: str, again: bool = False) -> Layers:
    own = _own_layers(spark, folder)
    model = FILE_FOREST.model()
    run_all(spark, own.raw, GOLD_PARAMS, own.layers, model=model)
    if again:
        run_gold(spark, GOLD_PARAMS, own.layers, "append", model)
    return own.layers


def q_files_to_gold(spark: SparkSession, folder: str) -> DataFrame:
    """Raw CSV files through every layer to the summary table."""
    summary = spark.table(_run_files(spark, folder).summary)
    return summary.select(
        F.col("turbine_id").cast("long").alias("turbine_id"),
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        "min_power",
        "max_power",
        "avg_power",
    )


def q_saved_analysis(spark: SparkSession, folder: str) -> DataFrame:
    """The saved analysis table, counted by turbine and flags."""
    saved = spark.table(_run_files(spark, folder).analysis)
    keys = ("z_anomaly", "if_anomaly", "combined_anomaly", "turbine_status")
    return saved.groupBy(F.col("turbine_id").cast("long").alias("turbine_id"), *keys).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def q_ratings_appended(spark: SparkSession, folder: str) -> DataFrame:
    """The saved ratings after a second gold run in append mode."""
    saved = spark.table(_run_files(spark, folder, again=True).ratings)
    return saved.withColumn("turbine_id", F.col("turbine_id").cast("long"))


def q_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that the bronze and silver jobs counted while they wrote."""
    own = _own_layers(spark, folder)
    counts = run_bronze(spark, own.raw, own.layers) | run_silver(spark, layers=own.layers)
    return spark.createDataFrame(sorted(counts.items()), "feed string, n_rows long")


def q_negative_power_voided(spark: SparkSession, folder: str) -> DataFrame:
    shifted = event_readings(spark, folder).withColumn("power_output", F.col("power_output") - 25)
    return void_negative_power(shifted).select("event_id", "power_output")


def write_odd_files(events: DataFrame, folder: str) -> None:
    """Two fleet files and two site files whose headers differ in order, with bad cells.

    Odd and even events are the two files of each feed. In fleet files every fiftieth
    wind speed cannot be read, in site files every fortieth power.
    """
    number = props_number()
    fleet = events.where(F.col("event_type") == "view").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.col("user_id").alias("turbine_id"),
        F.when(F.col("event_id") % 50 == 0, "n/a").otherwise((number * 0.25).cast("string")).alias("wind_speed"),
        (number * 3.0).alias("wind_direction"),
        (F.col("value") - 25).alias("power_output"),
    )
    sites = site_rows(events.where(F.col("event_type") != "view")).withColumn(
        "Power", F.when(F.col("event_id") % 40 == 0, "bad").otherwise(F.col("Power").cast("string"))
    )
    for rows, names, hidden in (
        (fleet, ("data_group_1.csv", "data_group_2.csv"), ("event_id",)),
        (sites, ("Location1.csv", "location2.csv"), ("event_id", "event_type")),
    ):
        columns = [name for name in rows.columns if name not in hidden]
        for odd, name in enumerate(names):
            part = rows.where(F.col("event_id") % 2 == odd)
            ordered = part.select(*(columns[::-1] if odd else columns))
            ordered.write.option("header", True).csv(f"{folder}/{name}")


def _odd_layers(spark: SparkSession, folder: str) -> OwnLayers:
    return _own_layers(spark, folder, write_odd_files)


def q_odd_files_to_silver(spark: SparkSession, folder: str) -> DataFrame:
    """Files with other column orders and bad cells, through to the silver table."""
    own = _odd_layers(spark, folder)
    run_bronze(spark, own.raw, own.layers)
    run_silver(spark, layers=own.layers)
    return spark.table(own.layers.readings).select(
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.col("turbine_id").cast("long").alias("turbine_id"),
        "wind_speed",
        "wind_direction",
        F.round("power_output", 6).alias("power_output"),
    )


def q_unreadable_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many records of each feed had cells that cannot be read."""
    own = _odd_layers(spark, folder)
    counts = run_bronze(spark, own.raw, own.layers) | run_silver(spark, layers=own.layers)
    return spark.createDataFrame(sorted(counts.items()), "feed string, n_rows long")


class BrokenLayers(Layers):
    """Layers whose analysis cannot be saved."""

    def save(self, df: DataFrame, table: str, *arguments: Any, **options: Any) -> None:
        if table == self.analysis:
            raise OSError("the second table of a gold run cannot be saved")
        super().save(df, table, *arguments, **options)


def q_rerun_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings of finished runs: one failed at its second table and ran again, one
    only failed, and one ran twice."""
    own = _own_layers(spark, folder)
    layers, model = own.layers, FILE_FOREST.model()
    broken = BrokenLayers(**{f.name: getattr(layers, f.name) for f in fields(layers)})
    run_bronze(spark, own.raw, layers)
    run_silver(spark, layers=layers)
    for run_id, chosen in (
        ("again", broken), ("again", layers), ("failed", broken), ("twice", layers), ("twice", layers),
    ):
        try:
            run_gold(spark, GOLD_PARAMS, chosen, model=model, run_id=run_id)
        except OSError:
            if chosen is layers:
                raise
    saved = layers.finished(spark, layers.ratings)
    return saved.withColumn("turbine_id", F.col("turbine_id").cast("long"))


def q_layers_reset(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the silver table of a named catalog, and its schemas after a reset."""
    own = _own_layers(spark, folder, catalog="spark_catalog")
    names = (own.layers.bronze, own.layers.silver, own.layers.gold)
    run_bronze(spark, own.raw, own.layers)
    run_silver(spark, layers=own.layers)
    kept = stage(spark.table(f"spark_catalog.{own.layers.readings}").groupBy().count(), "rows")
    drop_schemas(spark, *names)
    left = sum(spark.catalog.databaseExists(name) for name in names)
    rows = owned(kept).frame.select(F.lit("readings").alias("step"), F.col("count").alias("n"))
    return rows.withColumn("schemas_left", F.lit(left).cast("long"))


def q_gold_grown(spark: SparkSession, folder: str) -> DataFrame:
    """The gold layer with a forest grown from its rows: what holds for every such forest.

    Rows far from all others are flagged, and no more rows than the share are by the
    forest; all rows are rated, and all with a turbine that is not faulty are kept.
    """
    far = F.col("event_id") % 100 == 0
    readings = clean_readings(event_readings(spark, folder)).withColumns(
        {
            "wind_speed": F.when(far, F.col("wind_speed") + 900.0).otherwise(F.col("wind_speed")),
            "power_output": F.when(far, 9e6).otherwise(F.col("power_output")),
        }
    )
    params = Params(faulty_rate=1.0)  # no turbine can pass it
    gold = owned(build_gold(readings, params, key=ROW_KEY))
    rated = gold.ratings.agg(F.sum("total_records").alias("n_rated"), F.count(F.lit(1)).alias("n_turbines"))
    kept = gold.analysis.agg(
        F.count(F.lit(1)).alias("n_kept"),
        (F.sum("if_anomaly") <= F.ceil(F.count(F.lit(1)) * 0.15)).alias("within_share"),
        F.sum(F.when(far, F.col("if_anomaly"))).alias("n_far_flagged"),
    )
    return rated.join(F.broadcast(kept))  # one row each


_owned: dict[str, list[Any]] = {}
_running: list[list[Any]] = []


def owned(thing: Any) -> Any:
    """Note what the running query keeps in the shared folder for its result to read."""
    if _running:
        _running[-1].append(thing)
    return thing


def release(name: str) -> None:
    """Delete what the last run of a query left; its result cannot be read any more."""
    for thing in _owned.pop(name, []):
        thing.release() if hasattr(thing, "release") else thing.discard()


def owning(name: str, query: Query) -> Query:
    """A query that first deletes what its own last run left for its result."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        release(name)
        _running.append([])
        try:
            result = query(spark, folder)
        except BaseException:
            _owned[name] = _running.pop()
            release(name)
            raise
        _owned[name] = _running.pop()
        return result

    return run


QUERIES: dict[str, Query] = {
    "clean_readings": q_clean_readings,
    "expected_power": q_expected_power,
    "site_feed_standardized": q_site_feed_standardized,
    "site_ids": q_site_ids,
    "merged_feeds": q_merged_feeds,
    "zscore_flags": q_zscore_flags,
    "combined_flags": q_combined_flags,
    "unit_status": q_unit_status,
    "healthy_readings": q_healthy_readings,
    "daily_summary": q_daily_summary,
    "forest_scores_fixed_model": q_forest_scores_fixed_model,
    "score_cut": q_score_cut,
    "forest_flags": q_forest_flags,
    "gold_chain_surrogate": q_gold_chain_surrogate,
    "gold_ratings": q_gold_ratings,
    "gold_analysis": q_gold_analysis,
    "gold_pipeline": q_gold_pipeline,
    "lineitem_gold": q_lineitem_gold,
    "files_to_silver": q_files_to_silver,
    "files_to_gold": q_files_to_gold,
    "saved_analysis": q_saved_analysis,
    "ratings_appended": q_ratings_appended,
    "row_counts": q_row_counts,
    "negative_power_voided": q_negative_power_voided,
    "odd_files_to_silver": q_odd_files_to_silver,
    "unreadable_rows": q_unreadable_rows,
    "rerun_after_failure": q_rerun_after_failure,
    "layers_reset": q_layers_reset,
    "gold_grown": q_gold_grown,
}
QUERIES = {name: owning(name, query) for name, query in QUERIES.items()}

# DuckDB rounds binary values; Spark rounds the printed decimal half up. Going
# through text and decimal reproduces the latter. Means are taken over integer
# cents for the same reason. Grown forests are random, so their SQL states what holds for
# all of them; the gold layer is checked with a forest written by hand.
SQL: dict[str, str] = {
    "clean_readings": """
        WITH raw AS (
          SELECT event_id, user_id AS turbine_id,
            CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS timestamp,
            CASE WHEN event_type = 'signup' THEN NULL
              ELSE CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25
            END AS wind_speed,
            value - 25 AS power_output
          FROM events)
        SELECT * FROM raw
        WHERE power_output >= 0 AND timestamp IS NOT NULL AND wind_speed IS NOT NULL
    """,
    "expected_power": """
        WITH t AS (
          SELECT event_id, value AS power_output,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25 AS wind_speed
          FROM events),
        p AS (
          SELECT *, 0.5::DOUBLE * 1.2::DOUBLE * 5024 * pow(wind_speed, 3)
            * 0.45::DOUBLE / 1000000 AS e
          FROM t)
        SELECT event_id,
          round(e::VARCHAR::DECIMAL(38,18), 6)::DOUBLE AS expected_power,
          round((power_output - e)::VARCHAR::DECIMAL(38,18), 6)::DOUBLE AS error
        FROM p
    """,
    "site_feed_standardized": """
        WITH t AS (
          SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k
          FROM events)
        SELECT event_id, date_trunc('second', ts) AS timestamp,
          round((k * 0.01::DOUBLE * 4.5::DOUBLE)::VARCHAR::DECIMAL(38,18), 6)::DOUBLE
            AS power_output,
          value AS wind_speed, k * 3 AS wind_direction
        FROM t
    """,
    "site_ids": """
        WITH f AS (
          SELECT event_id, CASE WHEN event_id % 11 = 0 THEN '/in/LocationX.csv'
            ELSE '/in/location' || user_id || '.csv' END AS source_file
          FROM events),
        m AS (SELECT coalesce(max(s_suppkey), 0) AS off FROM supplier)
        SELECT event_id,
          TRY_CAST(regexp_extract(source_file, 'Location([0-9]+)[^/]*$', 1, 'i')
            AS INTEGER) + off AS turbine_id
        FROM f, m
    """,
    "merged_feeds": """
        SELECT user_id AS turbine_id, ts AS timestamp, value AS power_output
        FROM events WHERE value >= 0
        UNION ALL
        SELECT l_suppkey AS turbine_id, l_shipdate AS timestamp,
          l_extendedprice AS power_output
        FROM lineitem
    """,
    "zscore_flags": """
        WITH t AS (
          SELECT event_id, value - 0.5::DOUBLE * 1.2::DOUBLE * 5024
            * pow(CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25, 3)
            * 0.45::DOUBLE / 1000000 AS e
          FROM events),
        s AS (SELECT avg(e) AS m, stddev_samp(e) AS sd FROM t)
        SELECT event_id,
          CAST(CASE WHEN abs(e - m) > 2.0 * sd THEN 1 ELSE 0 END AS INTEGER)
            AS z_anomaly
        FROM t, s
    """,
    "combined_flags": """
        WITH f AS (
          SELECT event_id,
            CASE WHEN event_type = 'signup' THEN NULL
              WHEN value > 100 THEN 1 ELSE 0 END AS z,
            CASE WHEN event_type = 'view' THEN NULL
              WHEN event_type = 'error' THEN 1 ELSE 0 END AS i
          FROM events)
        SELECT event_id,
          CAST(CASE WHEN z = 1 OR i = 1 THEN 1 ELSE 0 END AS INTEGER)
            AS combined_anomaly
        FROM f
    """,
    "unit_status": """
        WITH f AS (
          SELECT nullif(user_id, 7) * 100 + day(ts) AS unit_id,
            CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag
          FROM events),
        g AS (
          SELECT unit_id, CAST(sum(flag) AS BIGINT) AS total_anomalies,
            count(*) AS total_records
          FROM f GROUP BY unit_id)
        SELECT *, total_anomalies / total_records::DOUBLE AS anomaly_rate,
          CASE WHEN total_anomalies / total_records::DOUBLE > 0.6 THEN 'FAULTY_SENSOR'
            WHEN total_anomalies / total_records::DOUBLE > 0.3 THEN 'REVIEW_REQUIRED'
            ELSE 'NORMAL' END AS turbine_status
        FROM g
    """,
    "healthy_readings": """
        WITH f AS (
          SELECT event_id, nullif(user_id, 7) * 100 + day(ts) AS unit_id,
            CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS flag
          FROM events),
        g AS (
          SELECT unit_id, sum(flag) / count(*)::DOUBLE AS r FROM f GROUP BY unit_id)
        SELECT f.event_id, f.unit_id,
          CASE WHEN r > 0.3 THEN 'REVIEW_REQUIRED' ELSE 'NORMAL' END AS turbine_status
        FROM f JOIN g ON f.unit_id = g.unit_id WHERE NOT r > 0.6
    """,
    "daily_summary": """
        SELECT user_id AS turbine_id, date_trunc('day', ts) AS window_start,
          round(min(value)::VARCHAR::DECIMAL(38,18), 2)::DOUBLE AS min_power,
          round(max(value)::VARCHAR::DECIMAL(38,18), 2)::DOUBLE AS max_power,
          ((2 * sum(round(value * 100)::BIGINT) + count(*)) // (2 * count(*)))::DOUBLE
            / 100 AS avg_power
        FROM events GROUP BY 1, 2
    """,
    "forest_scores_fixed_model": """
        WITH t AS (
          SELECT event_id, value AS p,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25 AS w
          FROM events),
        s AS (
          SELECT event_id, pow(2.0::DOUBLE, -((
            (CASE WHEN w <= 5 THEN 3 WHEN p <= 60 THEN 4 ELSE 1 END)
            + (CASE WHEN p <= 150 THEN 4 ELSE 1 END)) / 2.0::DOUBLE)
            / 10.244770920116851::DOUBLE) AS sc
          FROM t),
        c AS (
          SELECT quantile_cont(round(sc::VARCHAR::DECIMAL(38,18), 9)::DOUBLE, 0.85)
            AS cut
          FROM s)
        SELECT event_id, round(sc::VARCHAR::DECIMAL(38,18), 9)::DOUBLE AS score,
          CAST(CASE WHEN round(sc::VARCHAR::DECIMAL(38,18), 9)::DOUBLE > cut
            THEN 1 ELSE 0 END AS INTEGER) AS if_anomaly
        FROM s, c
    """,
    "score_cut": """
        WITH c AS (SELECT quantile_cont(l_extendedprice, 0.85) AS cut
          FROM lineitem)
        SELECT l_orderkey, l_linenumber,
          CAST(CASE WHEN l_extendedprice > cut THEN 1 ELSE 0 END
            AS INTEGER) AS if_anomaly
        FROM lineitem, c
    """,
    "gold_chain_surrogate": """
        WITH t AS (
          SELECT event_id, user_id AS turbine_id, ts, event_type,
            value * 0.37::DOUBLE - 3 AS p,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25 AS w
          FROM events WHERE value * 0.37::DOUBLE - 3 >= 0),
        e AS (
          SELECT *, 0.5::DOUBLE * 1.2::DOUBLE * 5024 * pow(w, 3) * 0.45::DOUBLE
            / 1000000 AS ep
          FROM t),
        s AS (SELECT avg(p - ep) AS m, stddev_samp(p - ep) AS sd FROM e),
        f AS (
          SELECT turbine_id, ts, round(p::VARCHAR::DECIMAL(38,18), 2)::DOUBLE AS p2,
            CASE WHEN abs(p - ep - m) > 2.0 * sd OR event_type = 'error'
              THEN 1 ELSE 0 END AS flag
          FROM e, s),
        g AS (SELECT turbine_id, sum(flag) / count(*)::DOUBLE AS r FROM f GROUP BY 1)
        SELECT f.turbine_id, date_trunc('day', ts) AS window_start,
          round(min(p2)::VARCHAR::DECIMAL(38,18), 2)::DOUBLE AS min_power,
          round(max(p2)::VARCHAR::DECIMAL(38,18), 2)::DOUBLE AS max_power,
          ((2 * sum(round(p2 * 100)::BIGINT) + count(*)) // (2 * count(*)))::DOUBLE
            / 100 AS avg_power
        FROM f JOIN g ON f.turbine_id = g.turbine_id WHERE NOT r > 0.35 GROUP BY 1, 2
    """,
    "files_to_silver": """
        WITH t AS (
          SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k
          FROM events),
        m AS (SELECT max(user_id) AS off FROM events WHERE event_type = 'view'),
        u AS (
          SELECT ts AS timestamp, user_id AS turbine_id, k * 0.25 AS wind_speed,
            k * 3 AS wind_direction, value - 25 AS power_output
          FROM t WHERE event_type = 'view'
          UNION ALL
          SELECT date_trunc('second', ts),
            off + dense_rank() OVER (ORDER BY event_type), value, k * 3,
            k * 0.01::DOUBLE * 4.5::DOUBLE
          FROM t, m WHERE event_type <> 'view')
        SELECT timestamp, turbine_id, wind_speed, wind_direction,
          round(power_output::VARCHAR::DECIMAL(38,18), 6)::DOUBLE AS power_output
        FROM u WHERE power_output >= 0
    """,
}

_ROUNDED = "round({}::VARCHAR::DECIMAL(38,18), 2)::DOUBLE"


def _gold_sql(source: str, forest: FixedForest, result: str, params: Params = GOLD_PARAMS) -> str:
    """The gold layer over ``source``, which gives row, turbine_id, ts, w and p.

    ``d`` ranks rows as the score does: the shorter the paths, the higher the score.
    """
    return f"""
        WITH t AS ({source}),
        e AS (
          SELECT *, 0.5::DOUBLE * 1.2::DOUBLE * 5024 * pow(w, 3) * 0.45::DOUBLE
            / 1000000 AS ep, -{forest.depth_sql()} AS d
          FROM t WHERE p >= 0),
        s AS (
          SELECT avg(p - ep) AS m, stddev_samp(p - ep) AS sd,
            quantile_cont(d, 0.85) AS cut FROM e),
        f AS (
          SELECT row, turbine_id, ts, {_ROUNDED.format('p')} AS p2,
            CAST(CASE WHEN abs(p - ep - m) > 2.0 * sd THEN 1 ELSE 0 END AS INTEGER)
              AS z_anomaly,
            CAST(CASE WHEN d > cut THEN 1 ELSE 0 END AS INTEGER) AS if_anomaly
          FROM e, s),
        c AS (SELECT *, greatest(z_anomaly, if_anomaly) AS combined_anomaly FROM f),
        g AS (
          SELECT turbine_id, CAST(sum(combined_anomaly) AS BIGINT) AS total_anomalies,
            count(*) AS total_records,
            sum(combined_anomaly) / count(*)::DOUBLE AS anomaly_rate
          FROM c GROUP BY 1),
        r AS (
          SELECT *, CASE WHEN anomaly_rate > {params.faulty_rate} THEN 'FAULTY_SENSOR'
            WHEN anomaly_rate > {params.review_rate} THEN 'REVIEW_REQUIRED'
            ELSE 'NORMAL' END AS turbine_status
          FROM g),
        a AS (
          SELECT c.*, turbine_status FROM c JOIN r ON c.turbine_id = r.turbine_id
          WHERE turbine_status <> 'FAULTY_SENSOR'),
        y AS (
          SELECT turbine_id, date_trunc('day', ts) AS window_start,
            {_ROUNDED.format('min(p2)')} AS min_power,
            {_ROUNDED.format('max(p2)')} AS max_power,
            ((2 * sum(round(p2 * 100)::BIGINT) + count(*)) // (2 * count(*)))::DOUBLE
              / 100 AS avg_power
          FROM a GROUP BY 1, 2)
        {result}
    """


_EVENT_SOURCE = """
          SELECT event_id AS row, user_id AS turbine_id, ts, value AS p,
            CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25 AS w
          FROM events"""
_LINE_SOURCE = """
          SELECT 0 AS row, l_suppkey AS turbine_id, l_shipdate AS ts,
            l_extendedprice AS p, l_quantity AS w
          FROM lineitem"""
_FILE_SOURCE = """
          SELECT 0 AS row, timestamp AS ts, turbine_id, wind_speed AS w, power_output AS p
          FROM (
            SELECT ts AS timestamp, user_id AS turbine_id,
              CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.25 AS wind_speed,
              value - 25 AS power_output
            FROM events WHERE event_type = 'view'
            UNION ALL
            SELECT date_trunc('second', ts),
              (SELECT max(user_id) FROM events WHERE event_type = 'view')
                + dense_rank() OVER (ORDER BY event_type),
              value,
              CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) * 0.01::DOUBLE
                * 4.5::DOUBLE
            FROM events WHERE event_type <> 'view')"""

SQL |= {
    "gold_ratings": _gold_sql(_EVENT_SOURCE, EVENT_FOREST, "SELECT * FROM r"),
    "gold_analysis": _gold_sql(
        _EVENT_SOURCE,
        EVENT_FOREST,
        "SELECT row AS event_id, turbine_id, p2 AS power_output, z_anomaly, if_anomaly, "
        "combined_anomaly, turbine_status FROM a",
    ),
    "gold_pipeline": _gold_sql(_EVENT_SOURCE, EVENT_FOREST, "SELECT * FROM y"),
    "lineitem_gold": _gold_sql(_LINE_SOURCE, LINE_FOREST, "SELECT * FROM y", Params()),
    "files_to_gold": _gold_sql(_FILE_SOURCE, FILE_FOREST, "SELECT * FROM y"),
    "saved_analysis": _gold_sql(
        _FILE_SOURCE,
        FILE_FOREST,
        "SELECT turbine_id, z_anomaly, if_anomaly, combined_anomaly, turbine_status, "
        "count(*) AS n_rows FROM a GROUP BY ALL",
    ),
    "ratings_appended": _gold_sql(
        _FILE_SOURCE, FILE_FOREST, "SELECT * FROM r UNION ALL SELECT * FROM r"
    ),
    "row_counts": """
        SELECT 'fleet' AS feed, count(*) AS n_rows FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'sites', count(*) FROM events WHERE event_type <> 'view'
        UNION ALL SELECT 'kept', count(*) FROM events
          WHERE event_type <> 'view' OR value >= 25
        UNION ALL SELECT 'fleet_unreadable', 0
        UNION ALL SELECT 'sites_unreadable', 0
    """,
    "negative_power_voided": """
        SELECT event_id, CASE WHEN value - 25 >= 0 THEN value - 25 END AS power_output
        FROM events
    """,
    "odd_files_to_silver": """
        WITH t AS (
          SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k
          FROM events),
        m AS (SELECT max(user_id) AS off FROM events WHERE event_type = 'view'),
        u AS (
          SELECT ts AS timestamp, user_id AS turbine_id, k * 0.25 AS wind_speed,
            k * 3 AS wind_direction, value - 25 AS power_output
          FROM t WHERE event_type = 'view' AND event_id % 50 <> 0
          UNION ALL
          SELECT date_trunc('second', ts), off + 1 + event_id % 2, value, k * 3,
            k * 0.01::DOUBLE * 4.5::DOUBLE
          FROM t, m WHERE event_type <> 'view' AND event_id % 40 <> 0)
        SELECT timestamp, turbine_id, wind_speed, wind_direction,
          round(power_output::VARCHAR::DECIMAL(38,18), 6)::DOUBLE AS power_output
        FROM u WHERE power_output >= 0
    """,
    "unreadable_rows": """
        SELECT 'fleet' AS feed, count(*) AS n_rows FROM events WHERE event_type = 'view'
        UNION ALL SELECT 'sites', count(*) FROM events WHERE event_type <> 'view'
        UNION ALL SELECT 'fleet_unreadable', count(*) FROM events
          WHERE event_type = 'view' AND event_id % 50 = 0
        UNION ALL SELECT 'sites_unreadable', count(*) FROM events
          WHERE event_type <> 'view' AND event_id % 40 = 0
        UNION ALL SELECT 'kept', count(*) FROM events
          WHERE CASE WHEN event_type = 'view' THEN value >= 25 AND event_id % 50 <> 0
            ELSE event_id % 40 <> 0 END
    """,
    "rerun_after_failure": _gold_sql(
        _FILE_SOURCE,
        FILE_FOREST,
        "SELECT r.*, run_id FROM r, (VALUES ('again'), ('twice')) AS runs(run_id)",
    ),
    "layers_reset": """
        SELECT 'readings' AS step, count(*) AS n, CAST(0 AS BIGINT) AS schemas_left
        FROM events WHERE event_type <> 'view' OR value >= 25
    """,
    "gold_grown": """
        WITH t AS (SELECT * FROM events WHERE value >= 0 AND ts IS NOT NULL)
        SELECT CAST(count(*) AS BIGINT) AS n_rated,
          count(DISTINCT user_id) + max(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END)
            AS n_turbines,
          count(user_id) AS n_kept, true AS within_share,
          CAST(count(user_id) FILTER (WHERE event_id % 100 = 0) AS BIGINT) AS n_far_flagged
        FROM t
    """,
    "forest_flags": """
        SELECT count(*) AS n_rows, true AS within_share,
          CAST(count(*) FILTER (WHERE event_id % 100 = 0) AS BIGINT) AS n_far_flagged
        FROM events
    """,
}
