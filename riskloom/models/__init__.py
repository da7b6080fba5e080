"""Default models: each ``fit_*`` returns a small model whose ``transform`` adds a probability."""
