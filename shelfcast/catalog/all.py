"""Importing this module registers every query."""

from shelfcast.catalog import aggregates, data, joins, model_checks, models, windows  # noqa: F401
