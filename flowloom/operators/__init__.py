"""Analyses over packets and flows: DataFrame in, DataFrame out."""
