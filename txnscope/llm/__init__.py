"""Training-data pipeline operators over the text tables.

Nothing else in txnscope imports this subpackage; ``__spark_entry__`` adds its
queries only when it can be imported.
"""
