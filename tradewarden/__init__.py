"""Transaction surveillance on Spark: load, enrich, profile, flag, score and publish trades."""

from tradewarden.params import Params

__all__ = ["Params"]
