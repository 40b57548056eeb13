"""Ingredient-safety analytics as Spark jobs: extract, match, roll up, search."""

from larderlens.session import configure, local_session

__all__ = ["configure", "local_session"]
