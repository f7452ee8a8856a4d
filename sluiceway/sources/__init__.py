"""Readers: files, batch folders, fixed-width text, JDBC."""
