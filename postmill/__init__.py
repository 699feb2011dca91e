"""Cleaning, quality scoring and profiling of job postings on Spark."""

from postmill.plans.cleaning import clean_postings
from postmill.plans.jobs import load_or_clean, run_cleaning, run_profile

__all__ = ["clean_postings", "load_or_clean", "run_cleaning", "run_profile"]
