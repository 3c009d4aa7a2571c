"""Training-data operators: one module per operator, thin queries in ``queries``.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its
queries only when the folder is there.
"""
