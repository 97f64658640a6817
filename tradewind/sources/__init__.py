"""Reading source files, writing warehouse tables, saving models."""
