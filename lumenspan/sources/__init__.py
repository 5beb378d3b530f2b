"""Where spans come from and where results go."""
