from starlift.sources.landing import discover_csv, publish_csv, read_landing
from starlift.sources.schemas import ENTITIES, KEYS
from starlift.sources.tables import Lake

__all__ = ["ENTITIES", "KEYS", "Lake", "discover_csv", "publish_csv", "read_landing"]
