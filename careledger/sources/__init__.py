"""Sources: the logical tables of the reports."""

from careledger.sources.catalog import Catalog
from careledger.sources.driver_tables import bind_driver_tables

__all__ = ["Catalog", "bind_driver_tables"]
