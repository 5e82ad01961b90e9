"""End-to-end jobs over a store: ingest, enrich, dataset, train, evaluate, score, report."""
