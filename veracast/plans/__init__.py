"""Assembled jobs: the pipeline that writes all tables, the query catalogue and its SQL checks."""
