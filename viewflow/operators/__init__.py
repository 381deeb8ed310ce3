"""DataFrame operators, the same for batch and stream unless they say otherwise."""
