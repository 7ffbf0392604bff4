"""Rows that every operator has to stand: null, empty, blank, one word, null id, very long without and with spaces."""

EDGES = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (None, "null id text"), (5, "x" * 70_000), (6, "a b " * 9_000)]
