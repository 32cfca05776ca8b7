"""The whole model graph over a set of sources."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame

from pampero.plans import dimensions, marts, staging, weather
from pampero.workspace import stage


def lazy(df: DataFrame, name: str) -> DataFrame:
    """Stand-in for `stage` that leaves a relation as a plan."""
    return df


def locations_only(df: DataFrame, name: str) -> DataFrame:
    """Stores the current locations alone and leaves days as a plan: the size of what days are
    joined with is known then before they are shuffled for it."""
    return stage(df, name) if name == "current_locations" else df


Source = DataFrame | Callable[[], DataFrame]


def _open(source: Source) -> DataFrame:
    return source if isinstance(source, DataFrame) else source()


@dataclass
class Models:
    """Relations by name, each built on first use.

    Sources are given as relations, or as functions that open them when first needed.
    `keep` stores relations read by several later ones (default: written once to the shared
    folder); pass `lazy` to keep everything one plan.
    """

    raw_weather: Source
    raw_locations: Source
    tax_csv: Source | None = None
    yield_csv: Source | None = None
    keep: Callable[[DataFrame, str], DataFrame] = field(default=stage)

    @cached_property
    def stg_weather(self) -> DataFrame:
        return staging.weather(_open(self.raw_weather))

    @cached_property
    def stg_locations(self) -> DataFrame:
        return staging.locations(_open(self.raw_locations))

    @cached_property
    def current_locations(self) -> DataFrame:
        current = dimensions.current_locations(self.stg_locations)
        return self.keep(current, "current_locations")

    @cached_property
    def best_weather(self) -> DataFrame:
        """Deduplicated weather: parsed, shuffled and written once, read by fact and dimension."""
        # Kept by location, days are ranked where they are written.
        best = getattr(self.keep, "best_days", weather.best_daily_rows)
        return self.keep(best(self.stg_weather), "best_weather")

    @cached_property
    def weather_base(self) -> DataFrame:
        return weather.daily_base(self.best_weather, self.current_locations)

    @cached_property
    def weather_metrics(self) -> DataFrame:
        return weather.with_metrics(self.weather_base)

    @cached_property
    def latest_day(self) -> DataFrame:
        # Both relations have the same newest day: a stored one is the cheaper to ask.
        return weather.latest_day(self.stg_weather if self.keep in (lazy, locations_only) else self.best_weather)

    @cached_property
    def weather_quality(self) -> DataFrame:
        return weather.with_quality(self.weather_metrics, self.latest_day)

    @cached_property
    def weather_only(self) -> DataFrame:
        best = self.best_weather
        if self.keep in (lazy, locations_only):
            # No days are stored to start from: only those of unlisted locations are ranked.
            listed = self.current_locations.select("location_id")
            unlisted = self.stg_weather.join(listed, "location_id", "left_anti")
            best = weather.best_daily_rows(unlisted)
        return dimensions.weather_only_locations(best, self.current_locations)

    @cached_property
    def dim_location(self) -> DataFrame:
        # Stored, its size is known before the fact is joined: while it is small the fact
        # is not shuffled for it.
        dim = dimensions.dim_location(self.current_locations, self.weather_only)
        return self.keep(dim, "dim_location")

    @cached_property
    def fct_rows(self) -> DataFrame:
        # One join with the dimension, which holds the catalogue, both completes and names.
        base = weather.daily_base(self.best_weather, self.dim_location)
        return marts.fct_rows(base, self.latest_day)

    @cached_property
    def fct_weather(self) -> DataFrame:
        return marts.fct_weather_daily(self.fct_rows)

    @cached_property
    def tax(self) -> DataFrame:
        return marts.tax_by_province(staging.tax(_open(self.tax_csv)))

    @cached_property
    def yields(self) -> DataFrame:
        # Read by the fact and, for its provinces, by the dimension the fact is joined with.
        yields = marts.yields_by_province(staging.yields(_open(self.yield_csv)))
        return self.keep(yields, "yields")

    @cached_property
    def province_mentions(self) -> DataFrame:
        return dimensions.province_mentions(self.current_locations, self.tax, self.yields)

    @cached_property
    def dim_province(self) -> DataFrame:
        return self.keep(dimensions.dim_province(self.province_mentions), "dim_province")

    @cached_property
    def fct_tax(self) -> DataFrame:
        return marts.fct_tax_province(self.tax, self.dim_province)

    @cached_property
    def fct_yield(self) -> DataFrame:
        return marts.fct_yield_province_campaign(self.yields, self.dim_province)

    @cached_property
    def campaign_weather(self) -> DataFrame:
        return marts.weather_by_campaign(self.fct_weather)

    @cached_property
    def mart_province_campaign(self) -> DataFrame:
        return marts.mart_province_campaign(self.fct_yield, self.campaign_weather, self.fct_tax)

    @cached_property
    def location_snapshot(self) -> DataFrame:
        return marts.location_snapshot(self.fct_weather, self.dim_location)
