"""DataFrame operators: dense keys, dimensions, facts, marts, checks, profiles."""

from starmart.operators import dims, facts, keys, marts, profile, quality
from starmart.operators.facts import Star, build_star, build_zone_star
from starmart.operators.keys import dense_key

__all__ = ["dims", "facts", "keys", "marts", "profile", "quality", "Star", "build_star", "build_zone_star", "dense_key"]
