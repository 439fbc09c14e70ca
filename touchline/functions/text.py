"""Ids, labels and names derived from text columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where a match id sits in a report URL.
MATCH_ID_PATTERN = r"/en/matches/([^/]+)/"

# URL fragments that give away the league, first match wins.
LEAGUE_BY_URL = (
    ("Bundesliga", "GER-Bundesliga"),
    ("Premier-League", "ENG-Premier League"),
    ("Ligue-1", "FRA-Ligue 1"),
    ("Serie-A", "ITA-Serie A"),
    ("La-Liga", "ESP-La Liga"),
)

# Codes for clubs whose first three letters would collide.
CLUB_CODES = {
    "Manchester Utd": "MUN",
    "Manchester City": "MCI",
    "Nott'ham Forest": "NFO",
    "Nottm Forest": "NFO",
    "Brighton": "BHA",
    "Newcastle Utd": "NEW",
    "West Ham": "WHU",
    "Wolves": "WOL",
    "Tottenham": "TOT",
    "Leicester City": "LEI",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_id(url: Column | str, pattern: str = MATCH_ID_PATTERN, strict: bool = False) -> Column:
    """First capture group; '' when a URL does not match, NULL for a NULL URL.

    With `strict`, a URL that does not match gives NULL as well.
    """
    found = F.regexp_extract(_col(url), pattern, 1)
    return F.nullif(found, F.lit("")) if strict else found


def joined_id(*parts: Column | str) -> Column:
    """Parts joined by '-'; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit("-"))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def infer_label(known: Column | str, text: Column | str,
                patterns: Sequence[tuple[str, str]] = LEAGUE_BY_URL) -> Column:
    """`known`, or the label of the first fragment that `text` contains."""
    options = [F.when(_col(text).contains(fragment), F.lit(label)) for fragment, label in patterns]
    return F.coalesce(_col(known), *options)


def mapped(key: Column | str, table: Mapping[str, str]) -> Column:
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.create_map(*entries)[_col(key)]


def tiered_code(code: Column | str, name: Column | str,
                table: Mapping[str, str] = CLUB_CODES) -> Column:
    """The provider's code, else the fixed table, else the first three letters."""
    return F.coalesce(_col(code), mapped(name, table), F.upper(F.substring(_col(name), 1, 3)))


def season_label(season: Column | str) -> Column:
    """'2526' becomes '2025/26'."""
    text = _col(season).cast("string")
    return F.concat(F.lit("20"), F.substring(text, 1, 2), F.lit("/"), F.substring(text, 3, 2))


def league_label(league: Column | str) -> Column:
    """Everything up to the last '-' is cut: 'ENG-Premier League' is 'Premier League'."""
    return F.regexp_replace(_col(league), r"^.*-", "")


def short_season(season: Column | str) -> Column:
    """'2025/26' becomes '25/26': the last two characters of each part."""
    parts = F.split(_col(season), "/")
    return F.array_join(F.transform(parts, lambda part: F.right(part, F.lit(2))), "/")


def plot_label(code: Column | str, season: Column | str) -> Column:
    return F.concat(_col(code), F.lit(" "), short_season(season))
