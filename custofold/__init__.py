"""Customer documents from mixed change records, as Spark jobs."""

from custofold.plans.batch import BatchConfig, run

__all__ = ["BatchConfig", "run"]
