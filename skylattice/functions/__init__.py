"""Column expressions: no shuffles, no state, no Python in the tasks."""
