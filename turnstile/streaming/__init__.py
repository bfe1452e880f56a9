"""turnstile.streaming."""
