"""Dimensional warehousing and period reporting as Spark DataFrame operators."""
