"""Sources. Each returns a tagged DataFrame (see ``operators.records``)."""
