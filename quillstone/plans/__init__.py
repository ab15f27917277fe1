"""Plans of the bibliographic engine."""
