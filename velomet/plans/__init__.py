"""Marts and analyses composed from the operators."""
