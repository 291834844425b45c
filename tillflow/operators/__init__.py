"""DataFrame-to-DataFrame steps; each works on batch and streaming input."""
