"""Operators of the bibliographic engine."""
