"""DataFrame-to-DataFrame operators, for batches and, unless they say otherwise, streams."""
