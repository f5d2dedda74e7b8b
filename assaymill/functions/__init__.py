"""Column expressions shared by the operators. All stay inside whole-stage codegen."""
