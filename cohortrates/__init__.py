"""Cohort incidence, prevalence and standardised rates as Spark DataFrame transformations."""

__version__ = "0.1.0"
