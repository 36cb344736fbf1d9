"""Training-data operators: dedup, filtering, scoring, tokenising and sharding of web-scale text.

Nothing outside this subpackage imports it.  Registered queries are in
``queries.py``; ``__spark_entry__`` adds them when the subpackage is present.
"""
