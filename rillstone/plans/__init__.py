"""Layered builds: raw tables to cleansed tables, dimensions, facts and marts."""
