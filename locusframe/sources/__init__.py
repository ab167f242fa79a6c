"""Readers: regions, phenotype tables, dosage files, VCF, annotations."""
