"""Column expressions; all of them built-in and inside code generation."""
