"""Where rows come from: topics, the archive, the collections."""
