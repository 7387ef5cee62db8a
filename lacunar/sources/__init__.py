"""Where grids come from and go to."""
