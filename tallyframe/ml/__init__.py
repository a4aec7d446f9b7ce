"""Supervised learning on tables: preparation, models, metrics, selection, scoring."""
