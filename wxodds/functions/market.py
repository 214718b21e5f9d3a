"""Market-side scalar functions: city, question type, target, outcome, Yes price."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These word lists and patterns must equal the reference's so that
# the same question text gives the same city, type, target and outcome.
# ---------------------------------------------------------------------------
WEATHER_KEYWORDS = ["rain", "temperature", "snow", "precipitation", "wind", "storm",
                    "weather", "hurricane", "flood"]
CITY_PATTERN_PRIMARY = r"\bin\s+([A-Z][a-zA-Z\s']+?)(?:\s+be\s|\s+on\s|\s+during|\s+for|\?|$)"
CITY_PATTERN_FALLBACK = r"temperature\s+(?:in\s+)?([A-Z][a-zA-Z\s]+?)(?:\s+on|\?|$)"
TEMP_PATTERN = r"(\d+(?:\.\d+)?)\s*°?([CF])"
HIGHEST_WORDS = ["highest", "maximum", "high temp"]
LOWEST_WORDS = ["lowest", "minimum", "low temp"]
ABOVE_WORDS = ["above", "exceed", "more than", "at least"]
BELOW_WORDS = ["below", "under", "less than"]
EXACT_TOLERANCE_C = 1.0
UNKNOWN_LOCATION = "UNKNOWN"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _contains_any(text: Column, words: list[str]) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def is_weather_text(text) -> Column:
    """Case-insensitive keyword test used by the ingest filter (null text -> false)."""
    return F.coalesce(_contains_any(F.lower(_c(text)), WEATHER_KEYWORDS), F.lit(False))


# the characters the patterns' \s matches, stripped from both ends of a captured name
_WHITESPACE = " \t\n\u000b\f\r"


def _strip(x: Column) -> Column:
    return F.btrim(x, F.lit(_WHITESPACE))


def _city_from(text: Column) -> Column:
    # The captured group starts with [A-Z], so an empty extract means "no match".
    t = F.coalesce(text, F.lit(""))
    first = F.nullif(_strip(F.regexp_extract(t, CITY_PATTERN_PRIMARY, 1)), F.lit(""))
    second = F.nullif(_strip(F.regexp_extract(t, CITY_PATTERN_FALLBACK, 1)), F.lit(""))
    return F.coalesce(first, second)


def parse_city(question, title) -> Column:
    """City from the question (two patterns), then from the event title; null when none match."""
    return F.coalesce(_city_from(_c(question)), _city_from(_c(title)))


def location_key(city) -> Column:
    """Partition key for a record: the city, or UNKNOWN when it is missing."""
    return F.coalesce(_c(city), F.lit(UNKNOWN_LOCATION))


def lower_text(question) -> Column:
    return F.lower(F.coalesce(_c(question), F.lit("")))


def question_type(question, lower=None) -> Column:
    """`lower`: the question in lower case, if at hand."""
    q = lower_text(question) if lower is None else _c(lower)
    return (F.when(_contains_any(q, HIGHEST_WORDS), F.lit("HIGHEST"))
            .when(_contains_any(q, LOWEST_WORDS), F.lit("LOWEST"))
            .otherwise(F.lit("EXACT")))


def target_temp(question) -> Column:
    """First '<number>[°]C|F' in the question, in °C; null when there is none."""
    # group 2 is a mandatory letter, so an empty unit means "no match"
    q = F.coalesce(_c(question), F.lit(""))
    unit = F.regexp_extract(q, TEMP_PATTERN, 2)
    value = F.regexp_extract(q, TEMP_PATTERN, 1).try_cast("double")
    celsius = F.when(unit == "F", (value - 32) * 5.0 / 9.0).otherwise(value)
    return F.when(unit != "", celsius)


def comparison(question, lower=None) -> Column:
    """How the question compares actual and target; `lower`: the question in lower case, if at hand."""
    q = lower_text(question) if lower is None else _c(lower)
    return (F.when(_contains_any(q, ABOVE_WORDS), F.lit("ABOVE"))
            .when(_contains_any(q, BELOW_WORDS), F.lit("BELOW"))
            .otherwise(F.lit("WITHIN")))


def compute_outcome(question, actual, target, compared=None) -> Column:
    """Did the Yes event happen: strict > / < for comparison words, else within ±1 °C.
    `compared`: the question's `comparison`, if at hand."""
    c = comparison(question) if compared is None else _c(compared)
    a, t = _c(actual), _c(target)
    return (F.when(c == "ABOVE", a > t)
            .when(c == "BELOW", a < t)
            .otherwise(F.abs(a - t) <= EXACT_TOLERANCE_C))


def _first_yes(tokens) -> Column:
    return F.get(F.filter(_c(tokens), lambda t: F.lower(t["outcome"]) == "yes"), 0)


def yes_price(tokens) -> Column:
    """Price of the first token named Yes (any case); 0.0 when there is none."""
    return F.coalesce(_first_yes(tokens)["price"], F.lit(0.0))


def yes_winner(tokens) -> Column:
    """The first Yes token's resolved flag (null when unresolved or absent)."""
    return _first_yes(tokens)["winner"]
