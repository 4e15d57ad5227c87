"""Training-data operators: ten corpus operators and the queries over them.

Each operator is a module with its own general interface; ``queries`` holds
the thin registered queries.  Nothing else in the library imports this package.
"""
