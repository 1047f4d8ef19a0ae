"""Targets: tables, text files, messages and databases."""
