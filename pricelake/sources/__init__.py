"""Readers and writers: raw JSON landing, list files, trade arrays, pages."""
