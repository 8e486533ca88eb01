"""Pipelines, query API and the warehouse layout."""
