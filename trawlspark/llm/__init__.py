"""Operators that prepare documents as training data. Nothing else in the package imports this folder."""
