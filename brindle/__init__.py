"""DataFrame operators for grouped, retrieval, evaluation-log and code-lineage analytics on Spark."""

__version__ = "0.1.0"
