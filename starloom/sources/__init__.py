"""Where rows come from: raw files, the test-table mapping, generated dates, seeds, stored tables."""
