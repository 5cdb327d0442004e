"""tickforge: tick-data analytics (bars, volume bars, funding, term
structures, keyed dedup/insert) as native Spark DataFrame plans."""

__version__ = "0.1.0"
