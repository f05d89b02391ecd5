"""Compositions of operators: curation, fares, and the whole pipeline."""
