"""Where pages come from and where tables go."""
