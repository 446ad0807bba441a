"""Column expressions. Native throughout: no Python runs on executors."""
