"""Readers for landed files. Every reader is lazy and takes or fixes its schema."""
