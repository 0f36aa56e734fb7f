"""Typed tables, marts, checks, publication and measures, each a function of DataFrames."""
