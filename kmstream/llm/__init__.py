"""Training-data operators: cleaning, deduplication, mixing, packing and chat formatting.

Nothing else in the library imports this subpackage. ``queries.py`` holds the
registered queries and their SQL; each operator lives in a module of its own
with a general interface.
"""
