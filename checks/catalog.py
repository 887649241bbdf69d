"""All queries in one place; importing this module registers them."""

from checks import catalog_loads, catalog_models, catalog_planted, catalog_quality, catalog_scalars, catalog_storage
from checks.registry import ENTRIES

__all__ = ["ENTRIES", "catalog_loads", "catalog_models", "catalog_planted", "catalog_quality", "catalog_scalars", "catalog_storage"]
