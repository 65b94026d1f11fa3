"""Readers and writers: review CSV, review rows from documents, result files, search index."""
