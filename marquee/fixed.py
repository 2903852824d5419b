"""Fixed values of the surveyed questions, stated together.

Fixed values: the names, codes, patterns and words below must equal the
surveyed system's for the questions to give the same results. Numeric
thresholds are the keyword defaults of each question function; the
catalogue binding keeps its own fixed values in ``sources/star.py``.
"""

# --- fixed values ----------------------------------------------------------
# Title types.
MOVIE = "movie"
TV_SERIES = "tvSeries"
TV_EPISODE = "tvEpisode"
VIDEO_GAME = "videoGame"
# Credit categories.
ACTOR = "actor"
ACTRESS = "actress"
DIRECTOR = "director"
WRITER = "writer"
ACTING = (ACTOR, ACTRESS)
# Genres named by questions.
ROMANCE = "Romance"
COMEDY = "Comedy"
THRILLER = "Thriller"
DOCUMENTARY = "Documentary"
# Region and language codes.
UKRAINE_REGION = "UA"
UKRAINIAN = "uk"
UNDETERMINED = "und"
# Named person, title word and name pattern.
PERSON = "Randall Ryan"
TITLE_WORD = "Ukraine"
LATIN_NAME = "^[A-Za-z .'-]+$"
# The year "recent" counts back from.
CURRENT_YEAR = 2025
# ---------------------------------------------------------------------------
