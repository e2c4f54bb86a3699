"""The six tables together and the pipelines that need several of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from depotline.functions.calendar import iso_year_week
from depotline.operators import enrich, evaluation as E, forecasting as M, inventory as I, marts, planning as P, weekly as W
from depotline.operators.lanes import add_carbon
from depotline.sources import bridge, catalog, readers
from depotline.stages import Job, stored


class Network:
    """Cleaned inputs and what is derived from them.

    Inputs are built on first use. Methods return plans; ``stored_*`` properties
    write their table once and read it back, so that the branches built on it
    share a single pass.
    """

    def __init__(self, load: Callable[[str], DataFrame], unpriced: bool = False, job: Job | None = None) -> None:
        """``load`` maps a catalog name to its cleaned table; with ``unpriced`` also ``held_inventory``, stock without values.

        With a ``job``, what is written once is a stage of that job, which a restart reads again.
        """
        self._load, self._unpriced, self._job = load, unpriced, job

    @classmethod
    def from_catalog(cls, spark: SparkSession, root: str, fmt: str = "parquet", job: Job | None = None) -> Network:
        return cls(lambda name: readers.load_tables(spark, root, {name: catalog.dataset(name).contract.names}, fmt)[name], job=job)

    @classmethod
    def from_benchmark(cls, spark: SparkSession, sf_dir: str) -> Network:
        views = {
            "daily_demand": bridge.daily_demand,
            "event_calendar": bridge.event_calendar,
            "sku_master": bridge.sku_master,
            "warehouses": bridge.warehouses,
            "warehouse_region_costs": bridge.lanes,
            "starting_inventory": bridge.starting_inventory,
            "held_inventory": bridge.held_inventory,
        }
        return cls(lambda name: views[name](spark, sf_dir), unpriced=True)

    @cached_property
    def demand(self) -> DataFrame:
        return self._load("daily_demand")

    @cached_property
    def calendar(self) -> DataFrame:
        return self._load("event_calendar")

    @cached_property
    def skus(self) -> DataFrame:
        return self._load("sku_master")

    @cached_property
    def warehouses(self) -> DataFrame:
        return self._load("warehouses")

    @cached_property
    def lanes(self) -> DataFrame:
        return self._load("warehouse_region_costs")

    @cached_property
    def stock(self) -> DataFrame:
        return self._load("starting_inventory")

    @cached_property
    def _held(self) -> DataFrame:
        """Stock rows before they are priced, where the inputs come that way."""
        return self._load("held_inventory") if self._unpriced else self.stock

    # --- demand ---------------------------------------------------------------
    def demand_with_category(self) -> DataFrame:
        return W.with_category(self.demand, self.skus)

    def weekly(self) -> DataFrame:
        """Weekly grain as a plan, for a single consumer."""
        return W.weekly_grain(self.demand_with_category())

    @cached_property
    def stored_weekly(self) -> DataFrame:
        """Weekly grain on disk: one pass over demand for everything built on it."""
        return stored(self._job, "weekly", self.weekly)

    def modelling_table(self, train_until=None) -> DataFrame:
        return enrich.modelling_table(self.stored_weekly, self.calendar, self.skus, self.warehouses, self.lanes, train_until)

    # --- forecast -------------------------------------------------------------
    def residuals(self) -> DataFrame:
        return E.persistence_residuals(self.stored_weekly)

    def residual_stats(self) -> DataFrame:
        return E.residual_stats(self.residuals())

    def forecast(self) -> DataFrame:
        """Twelve-week persistence forecast with its interval, one row per week and segment."""
        forward = E.add_interval(E.forward_persistence(self.stored_weekly), self.residual_stats())
        return forward.withColumn("year_week", iso_year_week(forward["week_start"]))

    # --- stock and plan -------------------------------------------------------
    def costed_lanes(self) -> DataFrame:
        return add_carbon(self.lanes, self.skus)

    def inventory_master(self) -> DataFrame:
        return I.inventory_master(self.stock, self.skus, self.warehouses)

    def units_by_site(self) -> DataFrame:
        """Sums stock as held: units need neither prices nor categories."""
        return I.units_by_site(self._held, self.warehouses)

    def utilisation(self) -> DataFrame:
        return I.warehouse_utilisation(self.stock, self.warehouses)

    def terms(self) -> DataFrame:
        return P.category_terms(self.skus)

    @cached_property
    def stored_stock(self) -> DataFrame:
        """Stock rows on disk, for plans that read them more than once."""
        return stored(self._job, "stock", lambda: self.stock)

    def safety_stock(self) -> DataFrame:
        return P.safety_stock(self.residual_stats(), self.lanes, self.terms())

    def requirements(self) -> DataFrame:
        return P.segment_requirements(self.forecast(), self.safety_stock())

    @cached_property
    def stored_options(self) -> DataFrame:
        """Segments x lanes of their region on disk; allocation reads them twice."""
        return stored(self._job, "options", lambda: P.lane_options(self.requirements(), self.lanes, self.terms()))

    def plan(self, scenarios: list[tuple] | None = None) -> DataFrame:
        return P.allocate_lanes(self.stored_options, scenarios)

    @cached_property
    def stored_plan(self) -> DataFrame:
        """The three-scenario plan on disk: segments x lanes x scenarios rows."""
        return stored(self._job, "plan", self.plan)

    def baseline(self) -> DataFrame:
        return P.baseline(self.forecast(), self.lanes, self.stock, self.terms())

    def recommendations(self) -> DataFrame:
        return P.warehouse_recommendations(self.stored_plan, self.warehouses)

    def marts(self) -> dict[str, DataFrame]:
        """The five exports, built on the stored weekly grain, stock and plan."""
        forecast = self.forecast()
        base = stored(self._job, "baseline", lambda: P.baseline(forecast, self.lanes, self.stored_stock, self.terms()))
        load = I.warehouse_utilisation(self.stored_stock, self.warehouses)
        return {
            "demand_summary": marts.demand_summary(self.stored_weekly),
            "forecast_summary": marts.forecast_summary(forecast),
            "inventory_summary": marts.inventory_summary(load, self.recommendations(), forecast),
            "cost_summary": marts.cost_summary(self.stored_plan, base),
            "carbon_summary": marts.carbon_summary(self.stored_plan, base),
        }


class ModelNetwork(Network):
    """The same plan from a fitted model instead of persistence.

    Forecast, interval and residual spread come from the model, and with them safety
    stock, requirements, allocation and marts. The spread is that of the model's own history.
    """

    #: What to fit; boosted trees on every feature, with the default rounds, unless set.
    pipeline: M.Estimator | None = None

    @property
    def estimator(self) -> M.Estimator:
        return self.pipeline or M.boosted_trees(M.MODEL_FEATURES)

    @cached_property
    def stored_features(self) -> DataFrame:
        """The joined table on disk; velocity and rank see all its weeks."""
        return stored(self._job, "features", self.modelling_table)

    @cached_property
    def fitted(self) -> M.FittedForecast:
        return M.fit(self.stored_features, self.estimator, M.features_of(self.estimator))

    def residuals(self) -> DataFrame:
        known = self.fitted.predict(self.fitted.usable(self.stored_features))
        return E.with_residual(known).select("week_start", *W.SEGMENT, E.TARGET, "predicted_units", "residual")

    def forecast(self) -> DataFrame:
        forward = E.add_interval(M.forward_forecast(self.fitted, self.stored_features, calendar=self.calendar), self.residual_stats())
        return forward.withColumn("year_week", iso_year_week(forward["week_start"]))
