"""Spec-driven builders that chain the operators."""
