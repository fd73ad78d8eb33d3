"""Training-data operators (documents, conversations, embeddings) as Spark jobs.

Nothing outside this subpackage imports it.
"""
