"""Screening-cohort processing as Spark DataFrame jobs."""
