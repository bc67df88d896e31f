"""Choosing regions and putting their plans together."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylane.functions.naming import normalise_region
from ferrylane.schemas import REGIONS
from ferrylane.session import local_frame

log = logging.getLogger(__name__)

# Words that ask for every region.
ALL_REGIONS = ("all", "*")


class RegionError(ValueError):
    """An unknown, missing or duplicated region."""


def _has_host(regions: DataFrame) -> DataFrame:
    host = F.trim(F.coalesce("host", F.lit("")))
    return regions.where((host != "") & ~host.contains("<") & ~host.contains(">"))


def regions_to_run(regions: DataFrame, requested: str | None) -> DataFrame:
    """The rows of ``regions`` a request covers: one by name, or all that have a host.

    Names compare without case, blanks or punctuation, never by prefix. Without any
    regions there is one database, given as a row without a region.
    """
    requested = (requested or "").strip()
    if regions.isEmpty():
        if requested:
            raise RegionError(f"region {requested!r} was asked for, but there are no regions")
        return local_frame(regions.sparkSession, [{}], REGIONS)
    keyed = regions.withColumn("__region", normalise_region(F.col("region")))
    counted = keyed.groupBy("__region").agg(
        F.count(F.lit(1)).alias("rows"), F.min("region").alias("one"), F.max("region").alias("other")
    )
    clash = counted.where(F.col("rows") > 1).first()
    if clash:
        raise RegionError(f"these are the same region: {clash['one']}, {clash['other']}")
    if not requested:
        raise RegionError("a region is required")
    if requested.lower() in ALL_REGIONS:
        usable = _has_host(regions)
        if usable.isEmpty():
            raise RegionError("no region has a host")
        return usable
    found = keyed.where(F.col("__region") == normalise_region(F.lit(requested))).drop("__region")
    if found.isEmpty():
        known = [r["region"] for r in regions.select("region").orderBy("region").collect()]
        raise RegionError(f"unknown region {requested!r}; known: {', '.join(known)}")
    return found


def union_of_regions(
    frames: Mapping[str, Callable[[], DataFrame]], load_mode: str | None = None
) -> tuple[DataFrame, dict[str, str]]:
    """Union the regions' frames, each tagged with its region.

    A region that fails is reported in the second result and does not stop the
    others; if every region fails, so does the call.
    """
    good, errors = [], {}
    for region, make in frames.items():
        try:
            good.append(make().withColumn("region", F.lit(region)))
        except Exception as error:
            log.warning("discovery failed for region %s: %s", region, error)
            errors[region] = str(error)
    if not good:
        listed = " | ".join(f"{region}: {error}" for region, error in errors.items())
        raise RegionError(f"every region failed: {listed}")
    union = reduce(DataFrame.unionByName, good)
    return (union.where(F.col("load_mode") == load_mode) if load_mode else union), errors
