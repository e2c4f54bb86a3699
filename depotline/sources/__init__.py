"""Reading and writing: dataset registry, readers, sinks, step audit, demo bridge."""
