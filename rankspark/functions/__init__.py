"""Column-level helpers (JVM-side expressions, no Python UDFs)."""

from .expr import *  # noqa: F401,F403
