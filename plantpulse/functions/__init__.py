"""Column expressions and the sliced-window helpers shared by the operators."""
