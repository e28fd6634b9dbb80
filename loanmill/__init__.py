"""Loan-application analytics as PySpark jobs: cleansing, star schema, quality, questions, retrieval."""

from loanmill.rules import Rules

__all__ = ["Rules"]
