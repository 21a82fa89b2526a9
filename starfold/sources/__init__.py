"""Readers and writers: files, JDBC options, landed pages, versioned tables."""
