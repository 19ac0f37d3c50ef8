"""Whole builds made of the operators."""
