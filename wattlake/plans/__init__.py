"""Whole models: staging, combined, fact, report and incremental refresh."""
