from orderlake.functions.keys import date_key, record_hash, surrogate_key
from orderlake.functions.money import exact_avg, exact_sum

__all__ = ["date_key", "exact_avg", "exact_sum", "record_hash", "surrogate_key"]
