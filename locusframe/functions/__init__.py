"""Column functions: keys, labels, genotype codes, Student's t."""
