"""Training-data operators.

Ten operators over ``documents``, ``pages``, ``embeddings`` and ``benchmark``,
one module each. Nothing else in the library imports this subpackage;
``registry`` holds the queries and their SQL.
"""
