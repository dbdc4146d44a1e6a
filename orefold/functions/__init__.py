"""Expressions shared by the operators, as SQL text.

Text is parsed by the session in one call, where a Column built step by step takes
one call per step; the plans are the same.
"""
