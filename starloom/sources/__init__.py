"""Readers and writers: CSV, JSON record documents, JDBC, Parquet staging and the versioned star."""
