"""Business views, measures, access rules and the daily run."""
