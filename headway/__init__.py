"""headway — transit schedule normalisation as Spark DataFrame jobs.

Source schedule tables (agencies, routes, stops, trips, stop times,
calendars, frequencies, shapes, fares) are rewritten into a pattern
normalised model: trips sharing stops and relative times collapse into
timed patterns and every trip becomes (timed pattern, start, calendar).
"""

from headway.config import MigrateConfig

__all__ = ["MigrateConfig"]
