"""Table and file sources, sinks, and the shared work folder."""
