"""turnstile.functions."""
