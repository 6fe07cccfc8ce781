"""The three layers, raw files to daily summaries, each a function of its own.

Layers communicate through tables only, so they can run as separate jobs.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetpulse.functions.moments import moment_sums, moments, with_limbs
from fleetpulse.operators.fleet import combine_flags, drop_rated_faulty, rate_turbines
from fleetpulse.operators.forest import (
    KEY,
    ForestModel,
    fit_forest,
    flag_above_quantile,
    row_counts,
    stage_scores,
    usable_rows,
)
from fleetpulse.operators.power import (
    flag_zscore,
    residual,
    round_power,
    with_expected_power,
)
from fleetpulse.operators.silver import (
    assign_site_ids,
    merge_feeds,
    standardize_site_feed,
)
from fleetpulse.operators.summary import summarize_power
from fleetpulse.params import Params
from fleetpulse.sources.feeds import UNREADABLE, read_fleet_feed, read_site_feed
from fleetpulse.sources.staging import Staged, stage
from fleetpulse.sources.tables import (
    RUN,
    create_schema,
    remove_run,
    save_run,
    save_table,
    use_catalog,
)

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Layers:
    """Where each layer's tables live and how they are stored."""

    bronze: str = "bronze_data"
    silver: str = "silver_data"
    gold: str = "gold_data"
    fmt: str = "parquet"
    # Folder for external tables; managed tables when not given.
    root: str | None = None
    # Catalog to make current first, e.g. a metastore; left alone when not given.
    catalog: str | None = None

    # The table names.
    @property
    def fleet_feed(self) -> str:
        return f"{self.bronze}.original_turbine_bronze"

    @property
    def site_feed(self) -> str:
        return f"{self.bronze}.new_turbine_bronze"

    @property
    def readings(self) -> str:
        return f"{self.silver}.wind_turbine_silver"

    @property
    def ratings(self) -> str:
        return f"{self.gold}.gold_turbine_stats"

    @property
    def analysis(self) -> str:
        return f"{self.gold}.gold_turbine_analysis"

    @property
    def summary(self) -> str:
        return f"{self.gold}.gold_turbine_summary"

    @property
    def runs(self) -> str:
        return f"{self.gold}.gold_turbine_runs"

    def save(
        self, df: DataFrame, table: str, mode: str = "overwrite", run_id: str | None = None
    ) -> None:
        location = None
        if self.root:
            schema = table.rpartition(".")[0]
            create_schema(df.sparkSession, schema, f"{self.root}/{schema}")
            location = f"{self.root}/{table.replace('.', '/')}"
        if run_id is None:
            save_table(df, table, mode, self.fmt, location)
        else:
            save_run(df, table, run_id, self.fmt, location)
        log.info("saved %s", table)

    def finished(self, spark: SparkSession, table: str) -> DataFrame:
        """The rows of a gold table that belong to finished runs.

        While a run is being saved, or after it failed, none of its rows is among them.
        """
        return spark.table(table).join(spark.table(self.runs).select(RUN), RUN, "left_semi")

    def enter(self, spark: SparkSession) -> None:
        if self.catalog:
            use_catalog(spark, self.catalog)


def run_bronze(
    spark: SparkSession, folder: str, layers: Layers = Layers()
) -> dict[str, int]:
    """Raw files to tables; the rows of each feed and how many had unreadable cells.

    Site ids start after the ids of the saved fleet feed.
    """
    layers.enter(spark)
    fleet, fleet_rows = _counted(read_fleet_feed(spark, folder, unreadable=True), "fleet")
    layers.save(fleet, layers.fleet_feed)
    sites, site_rows = _counted(read_site_feed(spark, folder, unreadable=True), "sites")
    numbered = assign_site_ids(sites, spark.table(layers.fleet_feed))
    layers.save(numbered, layers.site_feed)
    return _report(fleet_rows, site_rows)


def run_silver(
    spark: SparkSession, params: Params = Params(), layers: Layers = Layers()
) -> dict[str, int]:
    """Both feeds in one layout, cleaned; one job writes and counts each feed and both."""
    layers.enter(spark)
    fleet, fleet_rows = _counted(spark.table(layers.fleet_feed), "fleet")
    sites = standardize_site_feed(spark.table(layers.site_feed), params)
    sites, site_rows = _counted(sites, "sites")
    kept, kept_rows = _counted(merge_feeds(fleet, sites), "kept")
    layers.save(kept, layers.readings)
    return _report(fleet_rows, site_rows, kept_rows)


def run_gold(
    spark: SparkSession,
    params: Params = Params(),
    layers: Layers = Layers(),
    mode: str = "overwrite",
    model: ForestModel | None = None,
    run_id: str | None = None,
) -> None:
    """Flags, ratings, the readings of sound turbines, and their daily summary.

    With a ``run_id`` the tables are partitioned by run, and ``mode`` is of no account:
    saving a run appends it, or replaces what an earlier attempt of the same run left.
    The run is noted in a table of its own when all three are saved, which publishes
    them together (see ``Layers.finished``).
    """
    layers.enter(spark)
    gold = build_gold(spark.table(layers.readings), params, model=model)
    try:
        if run_id is not None:
            remove_run(spark, layers.runs, run_id)
        layers.save(gold.ratings, layers.ratings, mode, run_id)
        layers.save(gold.analysis, layers.analysis, mode, run_id)
        layers.save(gold.summary, layers.summary, mode, run_id)
        if run_id is not None:
            now = spark.range(1).select(F.current_timestamp().alias("finished_at"))
            layers.save(now, layers.runs, run_id=run_id)
    finally:
        gold.release()


def run_all(
    spark: SparkSession,
    folder: str,
    params: Params = Params(),
    layers: Layers = Layers(),
    mode: str = "overwrite",
    model: ForestModel | None = None,
    run_id: str | None = None,
) -> dict[str, int]:
    """All three layers; the row counts of the first two."""
    counts = run_bronze(spark, folder, layers)
    counts |= run_silver(spark, params, layers)
    run_gold(spark, params, layers, mode, model, run_id)
    return counts


@dataclass(frozen=True)
class Gold:
    ratings: DataFrame
    analysis: DataFrame
    summary: DataFrame
    staged: tuple[Staged, ...]

    def release(self) -> None:
        """Delete what the three frames read from; they cannot be used afterwards."""
        for intermediate in self.staged:
            intermediate.discard()


def build_gold(
    readings: DataFrame,
    params: Params = Params(),
    key: tuple[str, ...] = KEY,
    model: ForestModel | None = None,
) -> Gold:
    """The three gold frames over clean readings.

    One pass counts the rows and takes the moments of the residual, a second draws the
    forest's sample (not for a given ``model``), a third scores the rows and writes
    them to the shared folder; everything after reads the columns it needs from there.
    Expected power and residual are not written, being cheaper to derive again. Rating
    and summary aggregate before they shuffle. Ratings are written too, being used
    three times and so that the joins with them can adapt (see ``drop_faulty``). The
    summary is filtered after aggregation rather than before, which gives the same
    rows, since faulty turbines go as a whole, and joins one row per turbine and day
    instead of every reading.
    """
    powered = with_expected_power(readings, params)
    limbs = with_limbs(powered, residual())
    first = limbs.agg(*row_counts(), *moment_sums()).first()
    mean, deviation = (F.lit(x).cast("double") for x in moments(first))
    spread = F.struct(mean.alias("mean"), deviation.alias("deviation"))
    if model is None:
        model = fit_forest(powered, params, key=key, rows=usable_rows(first))
    flagged = flag_zscore(powered, params, spread)
    staged = [stage_scores(flagged, model, "expected_power", "error")]
    try:
        derived = round_power(with_expected_power(staged[0].frame, params))
        rows = combine_flags(
            flag_above_quantile(derived, params).select(
                *readings.columns, "expected_power", "error", "z_anomaly", "if_anomaly"
            )
        )
        rated = stage(rate_turbines(rows, params), "ratings")
        staged.append(rated)
        analysis = drop_rated_faulty(rows, rated.frame)
        summary = drop_rated_faulty(summarize_power(rows, params), rated.frame)
        return Gold(rated.frame, analysis, summary.drop("turbine_status"), tuple(staged))
    except BaseException:
        for intermediate in staged:
            intermediate.discard()
        raise


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows as the job that uses ``df`` runs, rather than in a job of its own."""
    rows, counts = Observation(name), [F.count(F.lit(1)).alias(name)]
    if UNREADABLE in df.columns:
        counts.append(F.count(UNREADABLE).alias(f"{name}_unreadable"))
    return df.observe(rows, *counts).drop(UNREADABLE), rows


def _report(*observations: Observation) -> dict[str, int]:
    counts = {name: rows for o in observations for name, rows in o.get.items()}
    for name, rows in counts.items():
        log.info("%s: %d rows", name, rows)
    return counts
