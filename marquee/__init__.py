"""Catalogue analytics on Spark.

Titles, ratings, people, credits, crews, episodes and localised titles are
loaded into a :class:`~marquee.sources.catalogue.Catalogue` of DataFrames and
queried with DataFrame operations only; every result is a lazy DataFrame that
Catalyst plans and Spark executes.

Entry points: :func:`load_catalogue` (the tab-separated dumps),
:func:`star_catalogue` (the star-schema Parquet tables), :func:`save_catalogue`
and :func:`table_catalogue` (bucketed tables), ``QUERIES`` (every question by
key) and :func:`export_csv` (results as CSV).
"""

from marquee.plans.registry import QUERIES
from marquee.sinks.csv import export_csv
from marquee.sources.catalogue import Catalogue
from marquee.sources.star import star_catalogue
from marquee.sources.store import save_catalogue, table_catalogue
from marquee.sources.tsv import load_catalogue

__all__ = ["Catalogue", "QUERIES", "export_csv", "load_catalogue", "save_catalogue",
           "star_catalogue", "table_catalogue"]
