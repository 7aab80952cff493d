"""Column expressions and the distributed helpers the operators share."""
