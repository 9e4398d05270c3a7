"""String expressions: ids, display labels, artist credits, JSON rows."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The id pattern of a track address, the address prefix and trend
# of a hand-entered row, and the credit separators of a multi-artist field.
TRACK_ID_PATTERN = r"track/([A-Za-z0-9]+)$"
TRACK_URL_PREFIX = "https://open.spotify.com/track/"
MANUAL_TREND = "SAME_POSITION"
CREDIT_SEPARATORS = r"(?i)\s*(?:,|&|;|\bfeat\.|\bft\.|\bfeaturing\b)\s*"


def id_from_url(url: Column | str, pattern: str = TRACK_ID_PATTERN) -> Column:
    """The id captured by `pattern`, null where the address is missing or does not match."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def surrogate_track_id(artist: Column, title: Column) -> Column:
    """The 22-character id given to rows that were typed in rather than scraped."""
    return F.substring(F.md5(F.concat(artist, F.lit(":"), title)), 1, 22)


def streak_label(title: Column | str, artist: Column | str) -> Column:
    return F.concat(F.substring(title, 1, 32), F.lit(" · "), F.substring(artist, 1, 18))


def split_credits(artist: Column | str) -> Column:
    """An array of trimmed, non-empty names credited in one artist field."""
    names = F.transform(F.split(artist, CREDIT_SEPARATORS), lambda name: F.trim(name))
    return F.filter(names, lambda name: name != "")


def or_dash(value: Column) -> Column:
    return F.coalesce(value, F.lit("—"))
