"""DataFrame operators the marts are composed of."""
