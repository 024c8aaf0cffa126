"""Registered queries on the star-schema tables, and their SQL counterparts."""
