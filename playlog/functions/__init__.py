"""Column functions (SURVEY FN-*, FLT-*)."""

from playlog.functions.scalars import *  # noqa: F401,F403
