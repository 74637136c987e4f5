"""Classification of zone descriptions into states, as one JVM-side expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State names and their postal abbreviations.
STATE_ABBREVIATIONS = {
    "Alabama": "AL",
    "Alaska": "AK",
    "Arizona": "AZ",
    "Arkansas": "AR",
    "California": "CA",
    "Colorado": "CO",
    "Connecticut": "CT",
    "Delaware": "DE",
    "District of Columbia": "DC",
    "Florida": "FL",
    "Georgia": "GA",
    "Hawaii": "HI",
    "Idaho": "ID",
    "Illinois": "IL",
    "Indiana": "IN",
    "Iowa": "IA",
    "Kansas": "KS",
    "Kentucky": "KY",
    "Louisiana": "LA",
    "Maine": "ME",
    "Maryland": "MD",
    "Massachusetts": "MA",
    "Michigan": "MI",
    "Minnesota": "MN",
    "Mississippi": "MS",
    "Missouri": "MO",
    "Montana": "MT",
    "Nebraska": "NE",
    "Nevada": "NV",
    "New Hampshire": "NH",
    "New Jersey": "NJ",
    "New Mexico": "NM",
    "New York": "NY",
    "North Carolina": "NC",
    "North Dakota": "ND",
    "Ohio": "OH",
    "Oklahoma": "OK",
    "Oregon": "OR",
    "Pennsylvania": "PA",
    "Rhode Island": "RI",
    "South Carolina": "SC",
    "South Dakota": "SD",
    "Tennessee": "TN",
    "Texas": "TX",
    "Utah": "UT",
    "Vermont": "VT",
    "Virginia": "VA",
    "Washington": "WA",
    "West Virginia": "WV",
    "Wisconsin": "WI",
    "Wyoming": "WY",
}

# The text patterns that mark a state in a zone description.
PART_PATTERN = r"\(([A-Z]{2}) Part\)"
TOKEN_PATTERN = r"(?U)\b([A-Z]{2})\b"
REMAINDER_PREFIX = "Remainder of "
REST_PREFIX = "Rest of "


def _after_prefix(text: Column, prefix: str) -> Column:
    rest = F.substr(text, F.lit(len(prefix) + 1))
    return F.regexp_replace(rest, r"(?U)^\s+|\s+$", "")


def infer_state(short_description: Column | str, long_description: Column | str) -> Column:
    """The state a zone belongs to, or NULL.

    The rules run from the most to the least specific text; "Rest of XX" is final even when XX is
    not a state, and of several bare abbreviations the last known one decides.
    """
    names = F.expr("array(" + ", ".join(f"'{name}'" for name in STATE_ABBREVIATIONS) + ")")
    by_abbreviation = F.expr(
        "map(" + ", ".join(f"'{short}', '{name}'" for name, short in STATE_ABBREVIATIONS.items()) + ")"
    )

    def known_name(text: Column) -> Column:
        return F.when(F.array_contains(names, text), text)

    def expand(abbreviation: Column) -> Column:
        return F.try_element_at(by_abbreviation, abbreviation)

    short = F.coalesce(F.col(short_description) if isinstance(short_description, str) else short_description, F.lit(""))
    long = F.coalesce(F.col(long_description) if isinstance(long_description, str) else long_description, F.lit(""))
    text = F.concat_ws(" ", short, long)

    part = expand(F.regexp_extract(text, PART_PATTERN, 1))
    remainder = F.when(long.startswith(REMAINDER_PREFIX), known_name(_after_prefix(long, REMAINDER_PREFIX)))
    tokens = F.filter(
        F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(1)),
        lambda token: F.map_contains_key(by_abbreviation, token),
    )
    last_token = expand(F.try_element_at(tokens, F.lit(-1)))

    return F.coalesce(
        part,
        known_name(short),
        remainder,
        F.when(short.startswith(REST_PREFIX), expand(_after_prefix(short, REST_PREFIX))).otherwise(
            F.coalesce(known_name(long), last_token)
        ),
    )
