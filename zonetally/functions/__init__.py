"""Column-in, column-out helpers and the fixed values they use."""
