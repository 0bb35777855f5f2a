"""Readers: text files and tables into the shapes the operators expect."""
