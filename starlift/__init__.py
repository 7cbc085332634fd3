"""starlift: lift relational CSV extracts into a star schema with Spark.

Layers: landing (CSV) -> bronze (raw tables) -> silver (denormalised sales,
dated stock snapshots) -> gold (dimensions, calendar, facts).
"""

from starlift.config import LakeConfig
from starlift.sources.tables import Lake

__all__ = ["Lake", "LakeConfig"]
