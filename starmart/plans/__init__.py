"""Composed entry points: extract, build, append, load_star, publish, run."""

from starmart.plans.pipeline import append, build, extract, load_star, publish, run

__all__ = ["append", "build", "extract", "load_star", "publish", "run"]
