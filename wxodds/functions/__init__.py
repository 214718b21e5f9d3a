"""Column-level functions shared by batch and streaming plans."""
from wxodds.functions.core import (  # noqa: F401
    fixed_text, half_up_ratio, half_away_ratio, int_floor_div, round4, scaled_int,
)
from wxodds.functions.market import (  # noqa: F401
    compute_outcome, is_weather_text, location_key, parse_city, question_type,
    target_temp, yes_price, yes_winner,
)
