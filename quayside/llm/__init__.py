"""Training-data operators: tokenising, packing, search, near duplicates, filters, WARC.

Every module holds one operator with a general DataFrame interface; ``queries`` holds
the thin registered queries. Nothing outside this package imports it.
"""
