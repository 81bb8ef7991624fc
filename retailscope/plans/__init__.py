"""Multi-operator plans: the fused feature table and the end-to-end run."""
