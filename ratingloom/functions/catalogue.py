"""Expressions over catalogue columns: title year, decade, genre list, genre group."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers that are not genres, and the seven groups.
NO_GENRE = "(no genres listed)"
IMAX = "IMAX"
OTHER = "Other"
GENRE_GROUPS = {
    "Crime/Mystery": ("Crime", "Mystery"),
    "Romance/Musical/Drama": ("Romance", "Musical", "Drama"),
    "Adventure/Fantasy/Animation": ("Adventure", "Fantasy", "Animation"),
    "Documentary/War": ("Documentary", "War"),
    "Horror/Thriller": ("Horror", "Thriller"),
    "Comedy/Children": ("Comedy", "Children"),
    "Action/Sci-Fi": ("Action", "Sci-Fi"),
}
YEAR_PATTERN = r"\((\d{4})\)"


def genre_list(genres: Column) -> Column:
    """Array of the genres in a pipe-separated string."""
    return F.split(genres, r"\|")


def genre_group(genre: Column) -> Column:
    """Group of one genre; everything outside the seven groups is ``Other``."""
    group = F.lit(OTHER)
    for name, members in GENRE_GROUPS.items():
        group = F.when(genre.isin(*members), name).otherwise(group)
    return group


def title_year(title: Column) -> Column:
    """First four-digit year in parentheses as an integer, NULL if the title has none."""
    return F.regexp_extract(title, YEAR_PATTERN, 1).try_cast("int")


def decade_label(year: Column) -> Column:
    """``1994`` becomes ``1990s``."""
    return F.concat((year - year % 10).cast("string"), F.lit("s"))
