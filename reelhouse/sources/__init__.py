from .tables import read_table, TEST_TABLES
from .adapters import RawTables, raw_tables

__all__ = ["read_table", "TEST_TABLES", "RawTables", "raw_tables"]
