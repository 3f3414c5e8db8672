"""Training-data operators.

Each module holds one operator with a general interface; ``queries`` binds
them to the tables. Nothing outside this subpackage imports it.
"""
