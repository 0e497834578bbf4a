"""Registered queries, their SQL twins and the derived inputs both share."""
