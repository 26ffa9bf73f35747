"""Training-data operators: de-duplication, filters, sharding, archives, tokens.

Nothing else in the library imports this subpackage; ``llm.queries`` holds the
registered queries and their oracle SQL.
"""
