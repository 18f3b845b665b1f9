"""The warehouse job, layer by layer: clean, integrity, model, measures."""
