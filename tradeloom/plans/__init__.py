"""Query catalogue: the star schema, the questions, the roll-ups and the templates."""
