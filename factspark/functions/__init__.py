"""Scalar functions: columns in, columns out, all of built-in expressions."""
