from headway.functions import columns, geo

__all__ = ["columns", "geo"]
