"""Declared checks over tables, and the gate that acts on them."""
