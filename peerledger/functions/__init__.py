"""Column expressions and plan-time helpers shared by the operators."""
