"""Fixed values of the movie warehouse. They must stay as they are for results to agree."""

import datetime as dt

DATA_SOURCE = "TMDb API v3"
SOURCE_URL = "https://api.themoviedb.org/3/movie/{id}"

LOOKBACK_DAYS = 3
CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
UNKNOWN_DATE_KEY = -1
UNKNOWN = "UNKNOWN"
FIRST_TREND_YEAR = 1980
MIN_RANKED_VOTES = 100
RECENT_YEARS = 5

GENRE_GROUPS = {
    "ACTION": "HIGH_OCTANE",
    "ADVENTURE": "HIGH_OCTANE",
    "THRILLER": "HIGH_OCTANE",
    "DRAMA": "NARRATIVE",
    "ROMANCE": "NARRATIVE",
    "HISTORY": "NARRATIVE",
    "COMEDY": "LIGHT",
    "FAMILY": "LIGHT",
    "ANIMATION": "LIGHT",
    "HORROR": "NICHE",
    "SCIENCE FICTION": "NICHE",
    "FANTASY": "NICHE",
    "MYSTERY": "NICHE",
    "CRIME": "NICHE",
    "DOCUMENTARY": "ARTS",
    "MUSIC": "ARTS",
    "WESTERN": "ARTS",
}
OTHER = "OTHER"

BLOCKBUSTER_GENRES = ("ACTION", "ADVENTURE", "SCIENCE FICTION", "FANTASY", "ANIMATION")

REGIONS = {
    "US": "NORTH_AMERICA",
    "CA": "NORTH_AMERICA",
    "MX": "NORTH_AMERICA",
    "GB": "EUROPE",
    "FR": "EUROPE",
    "DE": "EUROPE",
    "IT": "EUROPE",
    "ES": "EUROPE",
    "JP": "ASIA_PACIFIC",
    "CN": "ASIA_PACIFIC",
    "KR": "ASIA_PACIFIC",
    "IN": "ASIA_PACIFIC",
    "AU": "ASIA_PACIFIC",
}

STUDIO_TIERS = {
    "Universal Pictures": "MAJOR_STUDIO",
    "Paramount Pictures": "MAJOR_STUDIO",
    "Warner Bros. Pictures": "MAJOR_STUDIO",
    "Columbia Pictures": "MAJOR_STUDIO",
    "Walt Disney Pictures": "MAJOR_STUDIO",
    "20th Century Fox": "MAJOR_STUDIO",
    "20th Century Studios": "MAJOR_STUDIO",
    "New Line Cinema": "MAJOR_STUDIO",
    "Metro-Goldwyn-Mayer": "MAJOR_STUDIO",
    "DreamWorks Pictures": "MAJOR_STUDIO",
    "Lionsgate": "MINI_MAJOR",
    "Focus Features": "MINI_MAJOR",
    "Miramax": "MINI_MAJOR",
    "A24": "INDIE",
    "Blumhouse Productions": "INDIE",
    "Bad Robot": "INDIE",
}

BUDGET_TIER_SCHEMA = (
    "tier_name string, min_budget_usd bigint, max_budget_usd bigint, tier_rank bigint"
)
BUDGET_TIERS = [
    ("MICRO", 0, 1000000, 1),
    ("LOW", 1000000, 10000000, 2),
    ("MID", 10000000, 40000000, 3),
    ("HIGH", 40000000, 100000000, 4),
    ("BLOCKBUSTER", 100000000, None, 5),
]
