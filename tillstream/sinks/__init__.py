"""Where rows go: day partitions, change logs, batch partitions."""
