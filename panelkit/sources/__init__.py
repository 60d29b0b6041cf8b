"""Sources and sinks: snapshot layouts, run-stamped tables, scraped pages."""
