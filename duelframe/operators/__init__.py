"""Operators: DataFrame -> DataFrame (or small result) building blocks."""
