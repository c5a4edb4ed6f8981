"""Column-level helpers: dates, safe arithmetic, modes, rule chains."""

from patronage.functions.columns import *  # noqa: F401,F403
