"""ferrylane: replicate whole database estates into append-only tables with Spark."""

__version__ = "0.1.0"
