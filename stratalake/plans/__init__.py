"""Declared tables, entity projections and the star schema."""
