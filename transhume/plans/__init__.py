"""Exports of the target tables, composed from the operators."""
