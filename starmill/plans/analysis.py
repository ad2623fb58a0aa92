"""Warehouse analyses by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmill.operators import kpi
from starmill.operators.enrich import enrich_fact
from starmill.plans.layers import Layers

# Fixed value: length of the top list of genres.
TOP_GENRES = 10


def enriched_fact(ly: Layers) -> DataFrame:
    return enrich_fact(ly["fact"], ly.dims())


def genre_fractional(ly: Layers) -> DataFrame:
    return kpi.genre_fractional(ly["fact"], ly["dw_bridge"], ly["dim_genre"])


def genre_membership(ly: Layers) -> DataFrame:
    return kpi.genre_membership(ly["fact"], ly["dw_bridge"], ly["dim_genre"])


def genre_weighted_kpis(ly: Layers) -> DataFrame:
    return kpi.genre_weighted_kpis(ly["fact"], ly["dw_bridge"], ly["dim_genre"])


def top_genres(ly: Layers) -> DataFrame:
    return kpi.top_k(genre_weighted_kpis(ly), "weighted_installs_count", TOP_GENRES, "genre_name")


def by_category(ly: Layers) -> DataFrame:
    return kpi.measures_by(ly["fact"], ly["dim_category"], "category")


def by_app_type(ly: Layers) -> DataFrame:
    return kpi.measures_by(ly["fact"], ly["dim_app_type"], "app_type")


def by_content_rating(ly: Layers) -> DataFrame:
    return kpi.measures_by(ly["fact"], ly["dim_content_rating"], "content_rating")


def over_time(ly: Layers) -> DataFrame:
    return kpi.snapshots_over_time(ly["fact"], ly["dim_last_updated_date"])
