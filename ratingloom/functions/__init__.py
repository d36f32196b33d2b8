"""Column expressions shared by the operators. All are built-ins, so they stay in generated code."""
