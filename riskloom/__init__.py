"""Consumer-credit analytics on Spark: cleaning, bureau history, default models, scorecards, marts."""
