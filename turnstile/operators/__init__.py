"""turnstile.operators."""
