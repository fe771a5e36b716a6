"""Operators for large text corpora: quality rules, near neighbours, personal data, token
counts, mixing, chat formatting, license scans, repeated passages, piece encoding, near copies.
Nothing else in the library imports this subpackage."""
