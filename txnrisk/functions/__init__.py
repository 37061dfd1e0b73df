from .time import (weekend_flag, night_flag, epoch_us, day_offset, second_offset,
                   from_epoch_ms, from_offset_seconds, parse_day, add_days, to_ntz)
from .numeric import safe_ratio, round_half_even

__all__ = ["weekend_flag", "night_flag", "epoch_us", "day_offset", "second_offset",
           "from_epoch_ms", "from_offset_seconds", "parse_day", "add_days", "to_ntz",
           "safe_ratio", "round_half_even"]
