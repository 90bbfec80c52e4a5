"""Column expressions and lineage helpers shared by the operators."""
