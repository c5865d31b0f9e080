"""Recipes: operators composed over the canonical tables."""
