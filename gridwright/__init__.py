"""gridwright: a Spark-native staffing and pay-grid mart.

Operators (``gridwright.operators``), sources (``gridwright.sources``),
scalar functions (``gridwright.functions``), the composed jobs
(``gridwright.plans``) and the publish step (``gridwright.sinks``). Every
operator takes and returns lazy DataFrames; nothing is collected.
"""

from gridwright.config import PRODUCTION, STANDIN, JobConfig

__all__ = ["JobConfig", "PRODUCTION", "STANDIN"]
__version__ = "0.1.0"
