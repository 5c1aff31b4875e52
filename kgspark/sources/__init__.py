"""Readers: articles in XML, plain texts, vocabularies, review tables, checkpoints."""
