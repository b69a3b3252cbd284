from .base import CatalogSource, JdbcPartitioning, JdbcSource, ParquetSource
from .fixtures import FixtureSource

__all__ = ["CatalogSource", "FixtureSource", "JdbcPartitioning", "JdbcSource", "ParquetSource"]
