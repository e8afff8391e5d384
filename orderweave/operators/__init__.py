"""Relational, ordered, lag and corroboration operators."""
