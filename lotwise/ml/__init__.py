"""Split, encoding, models, tuning, evaluation, scoring and attribution."""
