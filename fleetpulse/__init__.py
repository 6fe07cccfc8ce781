"""Fleet telemetry analytics on Spark DataFrames."""

from fleetpulse.params import Params

__all__ = ["Params"]
