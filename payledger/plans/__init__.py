"""Dataset builders: each is ``(tables, cfg) -> DataFrame``."""
