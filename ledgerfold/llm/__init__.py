"""Operators for texts that people typed or that a language model reads; the core does not import them."""
