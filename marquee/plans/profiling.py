"""Profiling questions over the whole catalogue (P1..P7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.operators import profile
from marquee.sources.catalogue import TABLES, Catalogue

DESCRIBED = ("startYear", "runtimeMinutes")


def dataset_info(cat: Catalogue) -> DataFrame:
    return profile.dataset_info({t: cat[t] for t in TABLES})


def column_info(cat: Catalogue) -> DataFrame:
    return profile.column_info({t: cat[t] for t in TABLES})


def preview(cat: Catalogue) -> DataFrame:
    return profile.preview(cat.basics, "tconst")


def numeric_summary(cat: Catalogue) -> DataFrame:
    return profile.numeric_summary({t: cat[t] for t in TABLES})


def describe_columns(cat: Catalogue, columns: tuple[str, ...] = DESCRIBED) -> DataFrame:
    return profile.summarize(cat.basics, list(columns), profile.DESCRIBE_STATS)


def categorical_distincts(cat: Catalogue) -> DataFrame:
    return profile.categorical_distincts({t: cat[t] for t in TABLES})


def runtime_rating_corr(cat: Catalogue) -> DataFrame:
    return profile.runtime_rating_corr(cat.basics, cat.ratings)


def title_type_profile(cat: Catalogue) -> DataFrame:
    return profile.title_type_profile(cat.basics)


def subset_means(cat: Catalogue) -> DataFrame:
    return profile.subset_means(cat.basics, cat.ratings)
