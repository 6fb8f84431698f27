from .clock import TEXT_FORMAT, moment, parse_day, parse_time, typed_time, latest, text_of
from .money import amount_of, mean_of, measured, sums, unmeasured

__all__ = ["TEXT_FORMAT", "moment", "parse_day", "parse_time", "typed_time", "latest", "text_of", "amount_of", "mean_of", "measured", "sums",
           "unmeasured"]
