"""Writers of data sets and reports."""
