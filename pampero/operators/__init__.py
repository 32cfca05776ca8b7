"""Relational building blocks: payload extraction, best row, upsert, checks."""
