"""Plans: the yearly batch and backfill that order the layers."""

from vaultspark.plans import pipeline

__all__ = ["pipeline"]
