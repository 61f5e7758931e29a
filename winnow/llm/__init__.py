"""Training-data pipeline operators.

Each module holds one operator with its own general interface; ``queries``
registers the digest queries built on them.  Nothing outside this subpackage
imports it.
"""
