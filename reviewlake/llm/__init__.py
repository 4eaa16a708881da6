"""Operators for preparing training text: tokens, fingerprints, filters, near duplicates, clean-up.

Nothing else in the library imports this subpackage.
"""
