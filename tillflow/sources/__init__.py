"""Readers: receipt CSV scan, typed staging reads."""
