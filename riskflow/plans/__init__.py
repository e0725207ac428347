"""End-to-end flow, the named query catalog and its SQL oracle."""
