"""The star schema, its views and the run that publishes it."""
