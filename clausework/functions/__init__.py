"""Column expressions and the few per-row kernels that no built-in function equals."""
