"""Operators for preparing training data. Nothing outside of this subpackage imports it."""
