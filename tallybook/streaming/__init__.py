"""Structured Streaming forms of the attempt-log reports."""
