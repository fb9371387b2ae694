"""Where rows come from and where they go: tables, dumps, serving stores, indexes."""
