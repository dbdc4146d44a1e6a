"""Where rows come from and go to: CSV landings, tables, versioned tables."""
