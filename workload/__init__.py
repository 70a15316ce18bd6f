"""The registered queries: portal tables derived from the given tables, every operator over them, and its SQL."""
