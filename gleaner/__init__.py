"""Gleaner: declarative PySpark analytics over semi-structured postings."""
