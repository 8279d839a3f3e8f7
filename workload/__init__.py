"""Queries over the given tables that exercise every operator, each with its SQL twin where one exists."""
