"""Training-data operators: quality rules, near-duplicates, URL filters, WARC archives,
source mixing, sequence packing, HTML rendering, secret scans, language identification
and document fingerprints.

Nothing else in the library imports this package.
"""
