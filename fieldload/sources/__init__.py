"""Sources: table loaders, prior-state loader, file listings, test fixtures."""

from .tables import Sources, State, read_sources, read_state, table, table_path

__all__ = ["Sources", "State", "read_sources", "read_state", "table", "table_path"]
