"""Composed jobs: preparation, description, model training, evaluation, forecast."""
