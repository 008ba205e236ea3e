from headway.sources.catalog import SourceCatalog
from headway.sources.sinks import write_target, write_all

__all__ = ["SourceCatalog", "write_target", "write_all"]
