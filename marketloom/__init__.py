"""App-catalogue ingest, cleaning, mining and scoring as Spark jobs."""
