"""Stand-in inputs built from the driver's tables, and the registered
queries (with their DuckDB SQL) that run the library on them."""

from .frames import Tables  # noqa: F401
