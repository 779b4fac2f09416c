"""Relational operators: index tables, matching, ranking, fusion, evaluation."""
