"""Retail sales cleaning, star-schema loading and reporting on Spark DataFrames."""
