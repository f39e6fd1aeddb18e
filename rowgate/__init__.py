"""File and event ingestion as Spark jobs: validate, quarantine, upsert, ledger."""
