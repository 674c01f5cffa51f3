"""Training-data operators: counting, scoring, formatting, deduplication, scans, mixing."""
