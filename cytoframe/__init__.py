"""Cytoframe: single-cell count analytics expressed as Spark DataFrame plans."""
