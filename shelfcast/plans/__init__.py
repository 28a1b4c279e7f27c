"""Whole jobs: bronze generators, silver, gold, features, model, alerts, reports."""
