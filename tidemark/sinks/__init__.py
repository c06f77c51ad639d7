"""Where finished rows go. Every sink is called as ``sink(df, batch_id)``."""
