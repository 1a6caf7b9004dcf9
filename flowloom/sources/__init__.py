"""Readers and writers: capture files, flow exports, text, and dated tables."""
