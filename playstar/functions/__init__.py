"""Column expressions shared by the plans; all of them stay inside code generation."""
