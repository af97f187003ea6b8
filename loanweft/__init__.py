"""Loan-outcome analytics as Spark jobs: label, profile, govern, split, fit, calibrate, decide."""

from loanweft.session import build_session

__all__ = ["build_session"]
