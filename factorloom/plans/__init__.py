"""Models: cleaned tables, factor scores, serving table."""
