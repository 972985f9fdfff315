"""Table jobs: bronze ingest, silver cleaning, gold analytics, and their DAG."""
