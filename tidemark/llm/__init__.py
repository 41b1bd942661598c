"""Training-data operators: scoring, deduplication, packing and binary output of text corpora.

Nothing else in the library imports this subpackage; it may be deleted as a whole.
"""
