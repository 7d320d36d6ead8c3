"""Whole analyses: tables in, table out."""
