"""Readers and writers of session tables, features, parameters and reports."""
