"""Jobs: table builders, the load, reports, checks and profiles."""
