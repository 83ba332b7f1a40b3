"""Operators for preparing language-model training data at scale.

Each module holds one operator with its own general interface; ``queries`` applies them to
whole tables. Nothing else in the library imports this subpackage.
"""
