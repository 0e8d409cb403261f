"""Training-data operators: the corpus operators and their checked queries.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it can be imported.
"""
