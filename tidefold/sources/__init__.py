"""Readers: tables, dump text and change logs."""
