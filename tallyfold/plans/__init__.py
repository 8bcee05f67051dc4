"""Masters, the sales register and the full set of reporting tables."""
