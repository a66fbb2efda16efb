"""Training-data operators: tokenisation, licence scans, personal data, token
counts, near-duplicates, packing, quality, language and web archives.

Nothing outside this package imports it. ``queries`` holds the registered
queries; each operator module has a general interface of its own.
"""
