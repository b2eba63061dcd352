"""Column-to-column expressions of the brokerage domain."""

from brokerdw.functions.exprs import *  # noqa: F401,F403
