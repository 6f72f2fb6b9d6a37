"""DataFrame-to-DataFrame operators; each works on batch and streaming input alike."""
