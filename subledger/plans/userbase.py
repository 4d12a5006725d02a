"""User-base rollups and their reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subledger import fixed_values as fixed
from subledger.functions import grouped_category, keyword_hit

LEVELS = {
    "service": ("date", "service_name", "tme_category"),
    "category": ("date", "tme_category"),
    "cpc": ("date", "cpc"),
}


def _usable(snapshots: DataFrame, groups: Mapping[str, str], excluded: Sequence[str]) -> DataFrame:
    return snapshots.where(~keyword_hit(F.col("service_name"), excluded)).select(
        "date", F.trim("service_name").alias("service_name"),
        grouped_category(F.col("tme_category"), groups).alias("tme_category"), "cpc", "count",
    )


def user_base_rollup(
    snapshots: DataFrame, level: str,
    groups: Mapping[str, str] = fixed.CATEGORY_GROUPS,
    excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS,
) -> DataFrame:
    """Users per date at one level: ``service`` (with category), ``category`` or ``cpc``."""
    keys = LEVELS[level]
    return _usable(snapshots, groups, excluded).groupBy(*keys).agg(F.sum("count").cast("bigint").alias("User_Base"))


def user_base_all_levels(
    snapshots: DataFrame,
    groups: Mapping[str, str] = fixed.CATEGORY_GROUPS,
    excluded: Sequence[str] = fixed.EXCLUDED_SERVICE_KEYWORDS,
) -> DataFrame:
    """The three levels in one pass over the snapshots.

    The rows are summed at the finest grain first, so grouping sets multiply the small result and not the scan.
    """
    finest = (
        _usable(snapshots, groups, excluded)
        .groupBy("date", "service_name", "tme_category", "cpc")
        .agg(F.sum("count").alias("n"))
    )
    columns = [F.col(c) for c in ("date", "service_name", "tme_category", "cpc")]
    sets = [[F.col(c) for c in LEVELS[name]] for name in ("service", "category", "cpc")]
    level = F.when(F.grouping("cpc") == 0, "cpc").when(F.grouping("service_name") == 0, "service").otherwise("category")
    return finest.groupingSets(sets, *columns).agg(
        level.alias("level"), F.sum("n").cast("bigint").alias("User_Base")
    ).select("level", "date", "service_name", "tme_category", "cpc", "User_Base")


def reconcile_user_base(
    by_service: DataFrame, by_cpc: DataFrame, dim: DataFrame, service: str | None = None, date: str | None = None
) -> DataFrame:
    """Service totals against the sum over the service's codes, per date; all services unless one is named."""
    if service is not None:
        by_service, dim = by_service.where(F.col("service_name") == service), dim.where(F.trim("service_name") == service)
    if date is not None:
        on = F.col("date") == F.lit(date).cast("date")
        by_service, by_cpc = by_service.where(on), by_cpc.where(on)
    totals = by_service.groupBy("service_name", "date").agg(F.sum("User_Base").alias("service_total"))
    named = dim.select("cpc", F.trim("service_name").alias("service_name"))
    sums = by_cpc.join(named, "cpc").groupBy("service_name", "date").agg(F.sum("User_Base").alias("cpc_sum"))
    cpc_sum = F.coalesce("cpc_sum", F.lit(0)).cast("bigint")
    return totals.join(sums, ["service_name", "date"], "left").select(
        "service_name", "date", "service_total", cpc_sum.alias("cpc_sum"),
        (F.col("service_total") - cpc_sum).alias("difference"),
    )
