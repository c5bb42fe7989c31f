"""Readers of count matrices, barcode lists, label tables, reads and annotations."""
