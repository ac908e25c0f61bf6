"""Column expressions; every one works alike on bounded and streaming frames."""
