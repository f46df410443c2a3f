"""Training-data operators: license scans, decontamination, near-duplicates, line dedup, mixing,
nearest neighbours, secret scans, token files, quality scores and URL filters.

One module per operator with its own general interface; ``queries`` holds the thin registered
queries and ``oracles`` their SQL. Nothing outside this package imports it.
"""
