"""Manifests, the catalog, cycle orchestration, and the registered queries."""
