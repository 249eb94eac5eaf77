"""Column expressions shared by the operators (all JVM-side built-ins)."""

from chartlens.functions.buckets import hash_bucket
from chartlens.functions.dates import month_of, release_day
from chartlens.functions.genre import genre_of

__all__ = ["hash_bucket", "month_of", "release_day", "genre_of"]
