"""Leadforge: credit-lead and credit-bureau analytics as Spark DataFrame programs."""
