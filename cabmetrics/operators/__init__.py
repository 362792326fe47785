"""DataFrame -> DataFrame operators: cleaning, features, profiles, splits, models."""

from . import clean, evaluate, features, models, profile, quantiles, split

__all__ = ["clean", "evaluate", "features", "models", "profile", "quantiles", "split"]
