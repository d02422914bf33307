"""Salary models and their evaluation."""
