"""Registered queries with SQL; importing the package registers them all."""

from rallyframe.plans import catalog, checks, games, season

__all__ = ["catalog", "checks", "games", "season"]
