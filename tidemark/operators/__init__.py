"""DataFrame-to-DataFrame operators; each works on batch data, the stateless ones on streams too."""
