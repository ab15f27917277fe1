"""Functions of the bibliographic engine."""
