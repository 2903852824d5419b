"""A tiny hand-made catalogue with the edge cases of FIXTURES.md section 3."""

from __future__ import annotations

from marquee.sources.catalogue import Catalogue
from marquee.sources.schemas import shaped_schema

N = None

BASICS = [
    # tconst, titleType, primaryTitle, originalTitle, isAdult, startYear, endYear, runtime, genres
    ("tt1", "movie", "Alpha", "Alpha", False, 2005, N, 100, ["Drama", "Comedy"]),
    ("tt2", "movie", "Beta", "Beta", False, 2010, N, 150, ["Comedy", "Romance"]),
    ("tt3", "movie", "Gamma", "Gamma", True, 2003, N, 130, ["Drama"]),
    ("tt4", "movie", "Delta", "Delta", False, 1999, N, N, N),
    ("tt5", "tvSeries", "Show", "Show", False, 2000, N, 30, ["Drama"]),
    ("tt6", "tvEpisode", "Show E1", "Show E1", False, 2001, N, 30, ["Drama"]),
    ("tt7", "tvEpisode", "Show E2", "Show E2", False, 2001, N, 30, ["Drama"]),
    ("tt8", "tvEpisode", "Show E0", "Show E0", False, 2001, N, 30, ["Drama"]),
    ("tt9", "videoGame", "Game", "Game", False, 2018, N, N, ["Action"]),
    ("tt10", "videoGame", "Game", "Game", False, 2020, N, N, ["Action"]),
    ("tt11", "videoGame", "Game", "Game", False, 2022, N, N, ["Action"]),
    ("tt12", "videoGame", "Game", "Game", False, N, N, N, ["Action"]),
    ("tt13", "tvEpisode", "Show E2b", "Show E2b", False, 2001, N, 30, ["Drama"]),
    ("tt14", "tvSeries", "Empty Show", "Empty Show", False, 2002, N, 40, ["Comedy"]),
    ("tt15", "tvSeries", "Show", "Show", False, 2010, N, 30, ["Drama"]),   # namesake series
    ("tt16", "tvEpisode", "Other E1", "Other E1", False, 2011, N, 30, ["Drama"]),
    ("tt17", "tvEpisode", "Orphan E1", "Orphan E1", False, 2011, N, 30, ["Drama"]),
]

RATINGS = [
    ("tt1", 8.5, 6000), ("tt2", 8.5, 7000), ("tt3", 8.5, 5000),
    ("tt5", 7.5, 1500), ("tt6", 8.0, 100), ("tt7", 9.0, 200), ("tt8", 7.0, 300),
    ("tt9", 7.0, 600), ("tt10", 7.5, 600), ("tt11", 7.5, 600), ("tt12", 8.0, 600),
    ("tt13", 7.0, 50), ("tt14", 6.0, 10), ("tt15", 6.5, 50), ("tt16", 10.0, 5),
    ("tt17", 1.0, 5),
]

EPISODE = [
    ("tt6", "tt5", 1, 1), ("tt7", "tt5", 1, 2), ("tt13", "tt5", 1, 2), ("tt8", "tt5", N, 1),
    ("tt16", "tt15", 1, 1),                                 # same series title, other id
    ("tt17", "tt99", 1, 1),                                 # parent missing from titles
]

PRINCIPALS = [
    # tconst, ordering, nconst, category, job, characters
    ("tt1", 1, "nm1", "actor", N, N), ("tt2", 1, "nm1", "actor", N, N),
    ("tt3", 1, "nm1", "actor", N, N), ("tt1", 2, "nm2", "director", N, N),
    ("tt2", 2, "nm2", "actor", N, N), ("tt3", 2, "nm3", "actress", N, N),
    ("tt1", 3, "nm1", "actor", N, N),                      # same person twice in one title
    ("tt9", 1, "nm9", "actor", N, N),                      # unknown person
]

CREW = [
    ("tt1", ["nm2", "nm4"], ["nm2"]),                      # director also writer
    ("tt2", ["nm5"], N),
    ("tt3", N, ["nm5"]),
    ("tt9", ["nm4"], N),
]

NAME = [
    ("nm1", "Ann Lee", N, N, N, ["tt1", "tt2", "tt3"]),
    ("nm2", "O'Brien", N, N, N, ["tt1", "tt2"]),
    ("nm3", "Bo 2", N, N, N, ["tt3"]),
    ("nm4", "Zoë", N, N, N, N),
    ("nm5", "Ann Lee", N, N, N, N),                        # namesake of nm1
    ("nm6", N, N, N, N, N),
]

AKAS = [
    # titleId, ordering, title, region, language, types, attributes, isOriginalTitle
    ("tt2", 1, "Бета", "UA", "uk", N, N, False),
    ("tt2", 2, "Бета 2", "UA", "uk", N, N, False),
    ("tt2", 3, "Beta", "US", "en", N, N, True),
    ("tt9", 1, "Game", "US", "en", N, N, True),
    ("tt9", 2, "Spiel", "DE", "und", N, N, False),
    ("tt9", 3, "Jeu", N, "fr", N, N, False),
    ("tt10", 1, "Game", "US", N, N, N, False),
]


def catalogue(spark, empty: bool = False) -> Catalogue:
    def df(table, rows):
        return spark.createDataFrame([] if empty else rows, shaped_schema(table))
    return Catalogue({
        "basics": df("basics", BASICS), "ratings": df("ratings", RATINGS),
        "episode": df("episode", EPISODE), "principals": df("principals", PRINCIPALS),
        "crew": df("crew", CREW), "name": df("name", NAME), "akas": df("akas", AKAS),
    })
