"""Operators for preparing language-model training data.

Each module holds one operator with its own general interface; ``catalog``
registers the thin queries over the driver's tables.  Nothing outside this
subpackage imports it.
"""
