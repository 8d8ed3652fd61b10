"""Whole jobs built from the operators, the query registry and its oracle SQL."""

from precinct.plans.jobs import aggregate_analysis, comparison, report, train_and_evaluate

__all__ = ["aggregate_analysis", "comparison", "report", "train_and_evaluate"]
