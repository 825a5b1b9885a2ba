"""Multi-step plans: bronze ingestion, silver chains, the medallion run."""
