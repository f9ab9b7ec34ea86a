"""Column-level building blocks."""

from driftcast.functions.columns import *  # noqa: F401,F403
