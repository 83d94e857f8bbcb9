"""Restoring referential integrity after surrogate keys were generated anew, with Spark DataFrames."""
