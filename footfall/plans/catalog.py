"""All registered queries (importing the modules registers them)."""

from footfall.plans import exports, library, pipeline, streams  # noqa: F401
from footfall.plans.registry import ORACLES, RUNS  # noqa: F401
