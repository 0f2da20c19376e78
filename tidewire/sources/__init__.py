"""Where rows come from: configuration, API descriptions, HTTP, pages, and the Spark data source."""
