"""Salary and job-market analytics as plain Spark DataFrame functions."""
