"""Sales-lead analytics on Spark DataFrames."""

from showroom.session import local_session

__all__ = ["local_session"]
