"""Readers: canonical views over parquet tables, landed files, plug-ins."""
