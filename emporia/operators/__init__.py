"""Relational building blocks shared by the table jobs."""

from emporia.operators.centroid import centroid
from emporia.operators.dedupe import dedupe
from emporia.operators.money import ALL, MONEY, ExactSum, mean_of, money_sums
from emporia.operators.profile import log_observed, observed, preview, profile
from emporia.operators.skew import balanced_join, splits_hot_keys

__all__ = [
    "centroid",
    "dedupe",
    "ALL",
    "MONEY",
    "ExactSum",
    "mean_of",
    "money_sums",
    "log_observed",
    "observed",
    "preview",
    "profile",
    "balanced_join",
    "splits_hot_keys",
]
