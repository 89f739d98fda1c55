"""Training-data operators: thirteen corpus-scale operators and the queries over them.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when it is present.
"""
