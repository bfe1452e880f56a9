"""turnstile.sources."""
