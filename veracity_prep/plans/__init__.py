"""Whole-corpus jobs composed from sources, functions and operators."""
