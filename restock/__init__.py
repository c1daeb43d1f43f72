"""Retail analytics for stockout-censored demand, written as Spark DataFrame operators."""
