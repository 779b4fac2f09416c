"""Readers and writers: corpus, judgments, side tables, shared working folder."""
