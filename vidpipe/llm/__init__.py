"""Training-data operators on documents, pages, conversations and a benchmark.

Nothing outside this folder imports it.  Each module holds one operator with a
general interface; ``registry`` holds the thin queries on the given tables.
"""
