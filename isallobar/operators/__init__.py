"""DataFrame operators over the canonical long form ``(keys..., r, c, value columns...)``."""
