"""Operators for preparing training data, each over whole tables of documents or vectors."""
