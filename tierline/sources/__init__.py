"""Scans and sinks: paged JSON, run folders, the keyed bronze store, JDBC."""
