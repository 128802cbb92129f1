"""Provider files, index sidecars, object stores and published tiles."""
