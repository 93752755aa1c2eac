"""Training-data operators on documents, conversations and embeddings.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries when it can be imported.
"""
