"""The toolkit's workflows as lazy plans: resource, uncensored resource, reference validation.

Stages hand DataFrames to each other.  Nothing is written in between; the caller decides
which tables to write, and Spark shares the scans and shuffles they have in common.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.config import (
    BiasThresholds, BootstrapConfig, Height, KaplanMeierCriteria, PowerCurve, RangeQaThresholds, RangeThresholds, TaxonomyBands,
)
from anemora.operators import (
    asof, bootstrap, cadence, censored, comparison, dependence, direction, empirical, kaplan_meier, nodes, power, ranges, seasonal,
)
from anemora.session import held
from anemora.sources.readers import uncensored_records

STAGES = ("taxonomy", "empirical", "quality", "nonparametric", "power", "node_summary", "dependence", "bootstrap", "wind_rose", "seasonal", "monthly_power", "seasonal_power")


@dataclass(frozen=True)
class ResourceOptions:
    bounds: RangeThresholds = field(default_factory=RangeThresholds)
    bands: TaxonomyBands = field(default_factory=TaxonomyBands)
    bias: BiasThresholds = field(default_factory=BiasThresholds)
    quality: RangeQaThresholds = field(default_factory=RangeQaThresholds)
    criteria: KaplanMeierCriteria = field(default_factory=KaplanMeierCriteria)
    curve: PowerCurve = field(default_factory=PowerCurve)
    height: Height = field(default_factory=Height)
    bootstrap: BootstrapConfig = field(default_factory=BootstrapConfig)
    air_density: float = 1.225
    min_confidence: float = 0.5
    min_in_weight: float = 500.0
    tie: str | None = None


def select_stages(include: Iterable[str] | None = None, skip: Iterable[str] = ()) -> list[str]:
    """Stage names in order; unknown names are an error."""
    wanted, skipped = set(include or STAGES), set(skip)
    unknown = sorted((wanted | skipped) - set(STAGES))
    if unknown:
        raise ValueError(f"unknown stages: {unknown}")
    return [s for s in STAGES if s in wanted and s not in skipped]


def compute_resource(obs: DataFrame, options: ResourceOptions = ResourceOptions(), include: Sequence[str] | None = None,
                     skip: Sequence[str] = (), settings: DataFrame | None = None) -> dict[str, DataFrame]:
    """One DataFrame per selected stage; a stage is built only if it or one that needs it is selected.

    ``settings`` has ``node_id`` and may have ``block_length`` and ``speed_scale`` for the bootstrap.
    """
    chosen = select_stages(include, skip)
    plan = _Resource(obs, options, settings)
    if "pred_wind_direction" not in obs.columns:
        chosen = [c for c in chosen if c != "wind_rose"]
    return {name: getattr(plan, name) for name in chosen}


class _Resource:
    """The resource stages; each is made on first use and shared by those that need it.

    The sample and the table of nodes, which several stages read, are written down.
    """

    def __init__(self, obs: DataFrame, options: ResourceOptions, settings: DataFrame | None) -> None:
        self.obs, self.options, self.settings = obs, options, settings

    @cached_property
    def taxonomy(self) -> DataFrame:
        return cadence.taxonomy(self.obs, bands=self.options.bands)

    @cached_property
    def empirical(self) -> DataFrame:
        return held(empirical.assemble_metrics(
            empirical.label_counts(self.obs), empirical.valid_metrics(self.obs), self.taxonomy, self.options.bias))

    @cached_property
    def quality(self) -> DataFrame:
        temporal = cadence.temporal_metrics(self.obs).withColumn("max_gap_hours", F.col("max_missing_seconds") / 3600.0)
        return ranges.range_quality(ranges.range_summary(ranges.labelled(self.obs, self.options.bounds)), temporal, self.options.quality)

    @cached_property
    def sample(self) -> DataFrame:
        return held(censored.censored_sample(self.obs, self.options.bounds, self.options.min_confidence))

    @cached_property
    def totals(self) -> DataFrame:
        return censored.sample_totals(self.sample)

    @cached_property
    def nonparametric(self) -> DataFrame:
        reasons = kaplan_meier.selection(self.empirical, self.options.criteria).select(
            "node_id", F.concat_ws(" | ", "selection_reasons").alias("reasons"), "km_selected")
        mass = self.totals.select("node_id", (F.col("left_weight") / F.col("total_weight")).alias("left_mass_ratio"))
        curves = kaplan_meier.km_summary(kaplan_meier.kaplan_meier(self.sample))
        return curves.join(mass, "node_id").join(reasons.where("km_selected").drop("km_selected"), "node_id")

    @cached_property
    def power(self) -> DataFrame:
        o = self.options
        summary = censored.selection_summary(self.obs, o.min_confidence).join(
            self.totals.select("node_id", F.col("in_weight").alias("valid_count")), "node_id", "left")
        return power.power_estimates(
            self.sample, summary, curve=o.curve, air_density=o.air_density, tail_speed=o.bounds.upper, min_in_weight=o.min_in_weight,
            criteria=o.criteria, height=o.height)

    @cached_property
    def node_summary(self) -> DataFrame:
        obs = self.obs
        geometry = nodes.any_row(obs, "node_id", "geometry") if "geometry" in obs.columns else (
            nodes.node_spine(obs).withColumn("geometry", F.lit(None).cast("binary")))
        return nodes.node_summary(self.power, self.empirical, self.nonparametric, geometry)

    @cached_property
    def dependence(self) -> DataFrame:
        return dependence.lag_metrics(self.obs, tie=[self.options.tie] if self.options.tie else ())

    @cached_property
    def bootstrap(self) -> DataFrame:
        return bootstrap.bootstrap_summary(self.obs, self.options.bootstrap, self.options.tie, settings=self.settings)

    @cached_property
    def wind_rose(self) -> DataFrame:
        return direction.wind_rose(self.obs, weight=F.col("pred_wind_speed"))

    @cached_property
    def seasonal(self) -> DataFrame:
        return seasonal.variation(seasonal.seasonal_slices(self.obs), seasonal.annual_slices(self.obs))

    @cached_property
    def monthly_power(self) -> DataFrame:
        return self._periods("monthly")

    @cached_property
    def seasonal_power(self) -> DataFrame:
        return self._periods("seasonal")

    def _periods(self, period: str) -> DataFrame:
        o = self.options
        return power.temporal_power(self.obs, period, bounds=o.bounds, min_confidence=o.min_confidence, curve=o.curve, air_density=o.air_density,
                                    min_in_weight=o.min_in_weight, criteria=o.criteria, height=o.height)


def uncensored_resource(series: DataFrame, *, node: str | None = None, node_name: str = "series", speed: str = "wind_speed",
                        timestamp: str = "timestamp", rmse: float = 0.0, replicas: int = 500, seed: int = 0) -> DataFrame:
    """Intervals for a series without posteriors; the error is the user's, speeds are not bounded above."""
    records = uncensored_records(series, node=node, node_name=node_name, speed=speed, timestamp=timestamp)
    config = BootstrapConfig(replicas=replicas, seed=seed, rmse=rmse, apply_rmse_noise=rmse > 0,
                             rmse_mode="velocity" if rmse > 0 else "none", thresholds=RangeThresholds(1e-9, 1e9))
    return bootstrap.bootstrap_intervals(records, config)


def validate_reference(obs: DataFrame, reference: DataFrame, *, tolerance_seconds: float = 1800, prefer_nearest: bool = True,
                       height: Height = Height(), min_in_weight: float = 500.0, sequence: str | None = None,
                       intervals: BootstrapConfig | None = BootstrapConfig(replicas=50)) -> dict[str, DataFrame]:
    """Alignment, direction errors and resource comparison with a reference series, with bootstrap bounds unless ``intervals`` is None."""
    matched = asof.synchronise(obs, reference, prefer_nearest=prefer_nearest, tolerance_seconds=tolerance_seconds, right_sequence=sequence)
    observations = comparison.observation_scopes(obs, matched)
    references = comparison.reference_scopes(reference, matched)
    rows = comparison.model_rows(observations, height=height, min_in_weight=min_in_weight).unionByName(
        comparison.reference_rows(references, height=height, min_in_weight=min_in_weight), allowMissingColumns=True)
    if intervals is not None:
        rows = comparison.with_intervals(rows, observations, references, intervals)
    out = {
        "matched": matched,
        "summary": asof.synchronisation_summary(matched, obs, reference),
        "comparison": rows,
        "differences": comparison.differences(rows),
    }
    if "pred_wind_direction" in obs.columns:
        out["direction"] = direction.scenario_metrics(matched, "pred_wind_direction", "wind_dir_ref", "range_flag", "range_flag_confident")
    return out
