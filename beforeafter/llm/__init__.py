"""Operators of a training-data pipeline (packing, filters, dedup, scoring,
mixing, search).  Nothing else in the library imports this subpackage."""
