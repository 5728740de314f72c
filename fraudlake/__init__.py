"""Fraud and risk analytics on card transactions, written as Spark DataFrame operators."""

__version__ = "0.1.0"
