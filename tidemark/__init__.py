"""Before/after impact analytics on Spark.

Measures what a dated policy event (such as a fuel-price rise) does to urban
mobility.  Every operator is a plain ``DataFrame -> DataFrame`` function.
"""

from tidemark.config import ImpactSettings
from tidemark.session import build_session

__all__ = ["ImpactSettings", "build_session"]
