"""Whole forecasting runs composed from the operators."""
