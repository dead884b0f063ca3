"""claimflow: insurance-claim ingestion, reconciliation and dispatch on Spark."""

__version__ = "0.1.0"
