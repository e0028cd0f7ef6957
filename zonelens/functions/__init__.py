"""Column expressions (all JVM-side, no Python UDF)."""

from zonelens.functions.names import *  # noqa: F401,F403
from zonelens.functions.timefmt import *  # noqa: F401,F403
