"""Column-expression helpers (all native, no Python UDFs)."""

from .labels import delta_bucket, futures_expiry_bucket, options_expiry_bucket
from .numeric import (dead_band_funding, ieee_div, ieee_ln, norm_cdf, null_div,
                      weighted_mean)
from .ordering import first_by, last_by
from .time import (bucket, format_ts_text, plus, seconds_between, truncate,
                   year_fraction)

__all__ = [
    "bucket", "dead_band_funding", "delta_bucket", "first_by", "format_ts_text",
    "futures_expiry_bucket", "ieee_div", "ieee_ln", "last_by", "norm_cdf",
    "null_div", "options_expiry_bucket", "plus", "seconds_between", "truncate",
    "weighted_mean", "year_fraction",
]
