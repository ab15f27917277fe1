"""Queries of the bibliographic engine."""
