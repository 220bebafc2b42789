"""DataFrame -> DataFrame steps. Nothing here starts a session or collects rows."""
