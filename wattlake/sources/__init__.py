from wattlake.sources.lake import Lake, read_source, register_source

__all__ = ["Lake", "read_source", "register_source"]
