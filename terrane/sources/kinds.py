"""Kinds of sources by name: what a collection's configuration calls a source, as a reader; and operations that derive one from others.

    @source_kind("lighthouses")
    def _(spark, path): ...

    read_source(spark, {"kind": "lighthouses", "path": "/data/lights"})
"""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.operators.geometry import edges
from terrane.operators.overlap import derive_intersect
from terrane.sources import pages
from terrane.sources import readers as R

SOURCE_KINDS: dict[str, Callable[..., DataFrame]] = {}
DERIVATIONS: dict[str, Callable[..., DataFrame]] = {}


def _into(registry: dict, name: str):
    def add(function):
        if name in registry:
            raise ValueError(f"{name} is taken")
        registry[name] = function
        return function

    return add


def source_kind(name: str):
    """Registers a reader (spark, options by name) under ``name``."""
    return _into(SOURCE_KINDS, name)


def derivation(name: str):
    """Registers an operation (first, second, options by name) on two tables of vertices."""
    return _into(DERIVATIONS, name)


def _chosen(registry: dict, what: str, name: str | None, options: dict, given: int) -> Callable[..., DataFrame]:
    if name not in registry:
        raise ValueError(f"unknown {what} {name}; known are {', '.join(sorted(registry))}")
    takes = list(inspect.signature(registry[name]).parameters.values())[given:]
    unknown = sorted(set(options) - {p.name for p in takes})
    missing = sorted(p.name for p in takes if p.default is p.empty and p.name not in options)
    if unknown or missing:
        raise ValueError(f"{what} {name}: " + "; ".join(f"{w} {', '.join(o)}" for w, o in (("unknown", unknown), ("missing", missing)) if o))
    return registry[name]


def read_source(spark: SparkSession, config: dict) -> DataFrame:
    """The table of a configured source: ``kind`` and the options of its reader, which are checked by name before anything is read."""
    options = {k: v for k, v in config.items() if k != "kind"}
    return _chosen(SOURCE_KINDS, "source kind", config.get("kind"), options, 1)(spark, **options)


def derive(operation: str, first: DataFrame, second: DataFrame, **options) -> DataFrame:
    """The table that a registered operation derives from two others."""
    return _chosen(DERIVATIONS, "operation", operation, options, 2)(first, second, **options)


@source_kind("feature_pages")
def _pages(spark: SparkSession, path: str, declared: int | None = None, expected: int | None = None, exclude: dict[str, list] | None = None) -> DataFrame:
    """``declared`` counts the layer as captured, ``expected`` what is left without features that have an excluded value."""
    pages.register(spark)
    reader = spark.read.format("feature_pages")
    found = (reader if declared is None else reader.option("declared", declared)).load(path)
    for key, values in (exclude or {}).items():
        found = found.where(~F.coalesce(F.col("properties")[key].isin(*map(str, values)), F.lit(False)))
    if expected is not None and (n := found.count()) != expected:
        raise ValueError(f"{path}: {n} features are left, {expected} are expected")
    return found


@source_kind("geojson")
def _geojson(spark: SparkSession, path: str) -> DataFrame:
    return R.read_geojson(spark, path)


@source_kind("csv")
def _csv(spark: SparkSession, paths: list[str], ids: tuple[str, ...] = ()) -> DataFrame:
    return R.read_csv_subsets(spark, paths, ids)


@source_kind("stations")
def _stations(spark: SparkSession, path: str) -> DataFrame:
    return R.read_stations(spark, path)


@source_kind("placemarks")
def _placemarks(spark: SparkSession, path: str) -> DataFrame:
    return R.read_placemark_keys(spark, path)


@source_kind("series")
def _series(spark: SparkSession, path: str) -> DataFrame:
    return R.read_series(spark, path)


@source_kind("sites")
def _sites(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    return R.read_sites(spark, path, columns)


@source_kind("derive")
def _derived(spark: SparkSession, operation: str, first: str, second: str, options: dict | None = None) -> DataFrame:
    """From two stored tables of vertices."""
    return derive(operation, spark.read.parquet(first), spark.read.parquet(second), **(options or {}))


@derivation("intersect")
def _intersect(first: DataFrame, second: DataFrame, min_area: float = 0.0, min_part: float = 0.0) -> DataFrame:
    return derive_intersect(edges(first), edges(second), min_area, min_part)
