"""Lazy DataFrame operators."""
