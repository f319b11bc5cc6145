"""Annolith: plan, run and analyse large item-annotation jobs on Spark."""

__version__ = "0.1.0"
